"""Operators 11 to 13: resampling, fill-in-the-middle and the id store, against brute force and round trips."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusforge.llm import encode, idstore, middle, resampling
from corpusforge.llm import words as W

SF = "/root/testdata/sf0.001"
TEXTS = st.lists(st.text(alphabet=st.sampled_from("aZ09 \n.é漢😀<>PSM"), max_size=60), max_size=8)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- 11: resampling ---------------------------------------------------------

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_features(text):
    w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute_resample(docs, target):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    s, t = (Counter(bucket(f) for _, x in rows for f in brute_features(x)[1]) for rows in (docs, target))
    n_s, n_t = sum(s.values()), sum(t.values())
    out, asked = [], []
    for at, (i, x) in enumerate(docs):
        n, f = brute_features(x)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000)))) for b in map(bucket, f)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n >= 20:
            asked.append(at)
    asked.sort(key=lambda at: (-out[at][3], out[at][0] is None, out[at][0]))
    for rank, at in enumerate(asked[:25 * len(asked) // 100], 1):
        out[at][4] = rank
    return sorted(map(tuple, out), key=str)


@settings(deadline=None, max_examples=150)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_features_equal_brute_force(texts, block):
    data, starts = W.flat(pa.array(texts, pa.string()))
    got = [Counter() for _ in texts]
    for one, at, two, at2 in resampling.features(data, starts, block):
        for b, i in zip([*one, *two], [*at, *at2], strict=True):
            got[i][int(b)] += 1
    assert got == [Counter(map(bucket, brute_features(t)[1])) for t in texts]


def test_long_words():
    texts = ["x" * 3_000_000 + " tail", "é" * 200 + " " + "b" * 65 + " c", "a" * 64 + " " + "a" * 64]
    found = [Counter() for _ in texts]
    for one, at, two, at2 in resampling.features(*W.flat(pa.array(texts)), 1000):
        for b, i in zip([*one, *two], [*at, *at2], strict=True):
            found[i][int(b)] += 1
    assert found == [Counter(map(bucket, brute_features(t)[1])) for t in texts]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_resampling_equals_brute_force(spark, table):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in table.collect()]
    got = resampling.resample(table.repartition(5), target)
    assert rows_of(got) == brute_resample(docs, [(r.item_id, r.text) for r in target.collect()])


def test_resampling_cases(spark):
    docs, none = documents(spark), empty(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = rows_of(resampling.resample(docs, none).drop("rank"))
    assert got == [r[:4] for r in brute_resample(rows, [])]
    got = [r.rank for r in resampling.resample(docs, docs).collect() if r.rank is not None]
    assert sorted(got) == list(range(1, 1 + sum(brute_features(t)[0] >= 20 for _, t in rows) * 25 // 100))
    assert resampling.resample(none, docs).count() == 0
    wordless = docs.withColumn("text", F.lit(None).cast("string"))
    assert {(r.n_features, r.weight, r["rank"]) for r in resampling.resample(wordless, wordless).collect()} == {(0, 0, None)}


@pytest.mark.parametrize("percent", [0, 30, 100])
def test_ranks_under_ties(spark, percent):
    """Two thirds of the rows are equal in all columns of the order."""
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("o"), (F.col("id") % 5 > 0).alias("asked")).repartition(6)
    got = resampling.top_ranks(rows, ["o"], "asked", percent).collect()
    assert len(got) == 3000 and all(r["rank"] is None for r in got if not r.asked)
    ranked = sorted((r["rank"], r.o) for r in got if r["rank"] is not None)
    assert ranked == list(zip(range(1, 24 * percent + 1), sorted(r.o for r in got if r.asked), strict=False))


# --- 12: fill in the middle -------------------------------------------------

@settings(deadline=None, max_examples=200)
@given(TEXTS, st.data())
def test_cuts_equal_code_points(texts, data):
    h1, h2 = (np.array([data.draw(st.integers(0, 2**32 - 1)) for _ in texts], np.int64) for _ in range(2))
    raw, starts = W.flat(pa.array(texts, pa.string()))
    n, lo, hi, x, y = middle.cuts(raw, starts, h1, h2)
    for i, t in enumerate(texts):
        a, b = sorted((int(h1[i]) % (len(t) + 1), int(h2[i]) % (len(t) + 1)))
        assert (n[i], lo[i], hi[i]) == (len(t), a, b)
        assert (bytes(raw[starts[i]:x[i]]).decode(), bytes(raw[x[i]:y[i]]).decode()) == (t[:a], t[a:b])


def brute_middle(i, t):
    t = t or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, "plain", len(t), None, None, t
    if h4 % 100 < 20:
        return i, "spm", len(t), a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return i, "psm", len(t), a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_middle_cases(spark):
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(["a<P>b", "<", "<<S", "S>", "<M><S>", "<<P" * 9, "P>" * 9, "漢é😀" * 40_000], 100)], "doc_id bigint, text string")
    docs = documents(spark).unionByName(extra, allowMissingColumns=True).withColumnsRenamed({"id": "output", "bucket": "form"})
    out = middle.transformed(docs)
    assert out.select("row.*").columns == docs.columns
    back = out.withColumn("back", middle.restored(F.col("output"), F.col("form")))
    got = back.select("row.doc_id", "form", "n", "prefix_chars", "middle_chars", "output", "row.text", "back").collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((brute_middle(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    assert all((r.text or "") == r.back for r in got)
    assert middle.middle_table(empty(spark)).count() == 0


def test_middle_moves_nothing(table):
    assert "Exchange" not in middle.middle_table(table)._jdf.queryExecution().executedPlan().toString()


# --- 13: id store -----------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(encode.vocabulary_path())


def expected(tokenizer, rows):
    """(doc_id, start, n_tokens, crc) of rows in key order."""
    out, start = [], 0
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_ids_of_the_whole_table(spark, table, tokenizer):
    got = idstore.id_table(table.repartition(7))
    want = expected(tokenizer, sorted((r.doc_id, r.text) for r in table.collect()))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_stored_keys(spark, table, tokenizer):
    """Look-ups from one process, of keys that are there and keys that are not, over several index files."""
    root = idstore.write_ids(table, part_keys=50)
    store = idstore.Store(root)
    assert store.format["parts"] > 2 and store.kind == np.dtype("<u2")
    for r in table.limit(20).collect():
        assert store.get(r.doc_id).tolist() == [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        assert store.get(r.doc_id, 1) is None
    assert store.get(-5) is None and store.get(None) is None
    asked = spark.createDataFrame([(0, 0), (0, 0), (-5, 0), (1, 3)], "key bigint, copy int")
    assert [(r.key, r.copy) for r in idstore.read_ids(spark, root, asked).collect()] == [(0, 0), (0, 0)]


def test_id_cases(spark, tokenizer):
    docs = documents(spark).unionByName(spark.createDataFrame([(50, "a <|endoftext|> b"), (51, "<|endoftext|>")], "doc_id bigint, text string"), allowMissingColumns=True)
    got = sorted((tuple(r) for r in idstore.id_table(docs.withColumnsRenamed({"id": "key", "row": "copy"})).collect()), key=lambda r: r[1])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert [r[0] for r in got] == sorted((i for i, _ in rows if i is not None)) + [None] * 3
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()  # gapless
    plain = lambda found: sorted((str(r[0]), *r[2:]) for r in found)
    assert plain(got) == plain(expected(tokenizer, rows))
    root = idstore.write_ids(empty(spark))
    assert idstore.read_ids(spark, root).count() == 0 and idstore.Store(root).get(1) is None


def test_copies_go_on_over_shards(spark):
    """An id that most rows have: its copies are numbered on from shard to shard."""
    docs = spark.range(400).select(F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(F.lit(9)).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        root = idstore.write_ids(docs.unionByName(docs.filter("doc_id = 9").withColumn("text", F.lit("same"))))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    keys = spark.read.parquet(f"{root}/keys")
    assert spark.read.parquet(f"{root}/shards").filter("first_key = 9 AND carried > 0").count() > 2
    assert sorted(r.copy for r in keys.filter("key = 9").collect()) == list(range(600))
    assert keys.distinct().count() == 700 and idstore.read_ids(spark, root).count() == 700


@settings(deadline=None, max_examples=60)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash(keys):
    keys = sorted(keys)
    digests = b"".join(map(idstore.key_digest, keys))
    numbers = np.arange(len(keys))
    content = idstore.build_index(digests, numbers, numbers * 3, numbers + 1)
    index = idstore.Index(lambda start, size: content[start:start + size])
    a, b = np.frombuffer(digests, ">u8").reshape(-1, 2).astype(np.uint64).T if keys else np.empty((2, 0), np.uint64)
    assert sorted(index.slots(a, b)) == numbers.tolist()  # minimal and perfect
    found = index.find(digests)
    assert (found["shard"] == numbers).all() and (found["offset"] == numbers * 3).all() and (found["n"] == numbers + 1).all()
    others = [k for k in range(40) if k not in keys]
    assert not index.find(b"".join(idstore.key_digest(k, 7) for k in others))["n"].any()


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="not distinct"):
        idstore.build_index(idstore.key_digest(1) * 2, *[np.zeros(2, int)] * 3)
