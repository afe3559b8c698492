"""Scans, sinks, streams and the end-to-end job on a small raw corpus of our own."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import articles as A
from corpusforge.sources import io


BODY = 'He said "so, then", and left; ' + " ".join(f"word{i}" for i in range(60))


def _article(k, **change):
    a = {"url": f"https://a.vn/{k}.htm", "title": f"Title, {k} \"q\"", "summary": f"Sum, \"{k}\"\nline", "content": f"{BODY} end {k}.",
         "source": "one" if k % 3 else "two", "category": f"c{k % 2}", "scraped_at": f"2025-05-07 10:{k:02d}:00"} | change
    return {key: v for key, v in a.items() if v != "MISSING"}


@pytest.fixture(scope="module")
def raw_dir():
    """20 good articles; then: two null URLs, a URL crawled twice, short, empty and missing content, no title, a corrupt file, a list for content."""
    objs = [_article(k) for k in range(20)]
    objs += [_article(20, url=None), _article(21, url=None), _article(22, url="https://a.vn/0.htm")]
    objs += [_article(23, content="too short"), _article(24, content=""), _article(25, content="MISSING"), _article(26, title="MISSING"), _article(27, summary="")]
    return _write_json_dir([*objs, "{not json", json.dumps(_article(28, content=["a", "list"]))])


def _write_json_dir(objs):
    d = tempfile.mkdtemp(prefix="cf-json-", dir="/tmp")
    for i, o in enumerate(objs):
        with open(os.path.join(d, f"x_{i}.json"), "w", encoding="utf-8") as f:
            f.write(o if isinstance(o, str) else json.dumps(o, ensure_ascii=False, indent=2))
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("not json")
    return d


def test_missing_key_vs_null_and_corrupt_file(spark):
    body = " ".join(["word"] * 60)
    d = _write_json_dir([
        {"url": "u1", "summary": "s", "content": body, "source": "x", "category": "c"},
        {"url": "u2", "summary": None, "content": body, "source": "x", "category": "c"},
        {"url": "u3", "content": body, "source": "x", "category": "c"},
        "{not json",
    ])
    raw = io.scan_raw_json(spark, d)
    assert raw.count() == 3  # the corrupt file and the .txt are skipped
    keys = {r.url for r in A.filter_required(raw, A.REQUIRED_BCD).collect()}
    assert keys == {"u1", "u2"}  # null present, missing absent
    reasons = {r.url: r.reason for r in A.reject_reason(raw, "b").collect()}
    assert reasons == {"u1": "kept", "u2": "empty_summary", "u3": "missing_key"}


def test_csv_round_trip_and_first_existing(spark):
    d = tempfile.mkdtemp(prefix="cf-csv-", dir="/tmp")
    df = spark.createDataFrame([("u", 'he said "hi",\nthen', "")], "url string, summary string, content string")
    io.write_csv(df, f"{d}/processed")
    back = io.read_first_existing(spark, [f"{d}/tokenised", f"{d}/processed"]).first()
    assert back.summary == 'he said "hi",\nthen'
    assert back.content is None  # empty field reads back null, as pandas does


def test_split_and_stats_sinks(spark):
    from corpusforge.operators import split as G
    from corpusforge.operators import stats as ST

    d = tempfile.mkdtemp(prefix="cf-sink-", dir="/tmp")
    df = spark.createDataFrame([(i, "s", "c") for i in range(40)], "k long, source string, category string")
    s = G.split_exact(df, "k")
    io.write_splits(s, f"{d}/splits")
    parts = sorted(x for x in os.listdir(f"{d}/splits") if x.startswith("split="))
    assert parts == ["split=test", "split=train", "split=validation"]
    for rows, total in ((df, 40), (df.limit(7), 7)):  # a rerun replaces the statistics
        io.write_stats(ST.dataset_stats(rows), f"{d}/stats")
        assert spark.read.json(f"{d}/stats").filter("kind = 'total'").first().n == total
    assert io.is_done(spark, f"{d}/stats")
    io.write_links_csv(spark.createDataFrame([("u", "s", "c")], "url string, source string, category string"),
                       f"{d}/links")
    assert io.read_csv(spark, f"{d}/links").columns == ["url", "source", "category"]


def test_documents_stream_equals_batch(spark):
    from conftest import SF_SMALL
    from corpusforge.streaming import stream as STR

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    batch = sorted(A.clean_article_c(A.documents_as_articles(docs, "first_line")).collect())
    folder = tempfile.mkdtemp(prefix="cf-parts-", dir="/tmp") + "/documents.parquet"
    docs.repartition(5).write.parquet(folder)
    for path in (f"{SF_SMALL}/documents.parquet", folder):  # a file, and a folder of part files
        stream = STR.read_table_stream(spark, path, max_files_per_trigger=2)
        streamed = STR.stream_to_table(A.clean_article_c(A.documents_as_articles(stream, "first_line")), "test-st1")
        assert sorted(streamed.collect()) == batch


def test_stream_dedupe_and_counts(spark, raw_dir):
    from corpusforge.streaming import stream as STR

    raw = STR.read_raw_stream(spark, raw_dir)
    d = tempfile.mkdtemp(prefix="cf-st2-", dir="/tmp")
    STR.run_to_files(STR.dedupe_stream(raw).drop("scraped_ts"), f"{d}/out", f"{d}/ck")
    urls = [r.url for r in spark.read.parquet(f"{d}/out").collect()]
    assert len(urls) == len(set(urls)) == 26 and None not in urls
    STR.run_counts(raw, f"{d}/cnt", f"{d}/ck2", {"both": F.concat_ws("/", "source", "category"), "sources": F.col("source")})
    counts = {(r.kind, r.key): r.n for r in STR.read_counts(spark, f"{d}/cnt").collect()}
    assert [counts["both", k] for k in ("one/c0", "one/c1", "two/c0", "two/c1")] == [10, 9, 5, 5]
    assert counts["sources", "one"] == 19 and counts["total", ""] == raw_count(spark, raw_dir)


def raw_count(spark, raw_dir):
    return len([x for x in os.listdir(raw_dir) if x.endswith(".json")])


def test_counts_of_repeated_and_killed_batches(spark):
    """A batch counts once, however often it is written; one without its end mark does not count; a compaction changes nothing."""
    from corpusforge.streaming import stream as STR

    d = tempfile.mkdtemp(prefix="cf-counts-", dir="/tmp")
    rows = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("k"))
    total = lambda: {(r.kind, r.key): r.n for r in STR.read_counts(spark, d).collect()}
    assert total() == {}
    for batch in (0, 1, 1, 0, 1):
        STR.write_partial(STR.partial_counts(rows, {"k": F.col("k")}), d, batch)
    want = {("total", ""): 200, ("k", "0"): 60, ("k", "1"): 60, ("k", "2"): 60}
    assert total() == want
    os.makedirs(f"{d}/batch=2")
    for name in (x for x in os.listdir(f"{d}/batch=1") if x.startswith("part")):  # killed while writing
        with open(f"{d}/batch=1/{name}", "rb") as a, open(f"{d}/batch=2/{name}", "wb") as b:
            b.write(a.read())
    assert total() == want
    STR.compact_counts(spark, d)
    assert total() == want
    STR.write_partial(STR.partial_counts(rows, {"k": F.col("k")}), d, 1)  # an old batch again
    STR.write_partial(STR.partial_counts(rows, {"k": F.col("k")}), d, 2)  # the killed one again
    assert total()["total", ""] == 300 and {r.key: r.n for r in STR.read_stats(spark, d).filter("kind = 'k'").collect()} == {"0": 90, "1": 90, "2": 90}
    STR.compact_counts(spark, d)
    assert {r.kind: r.n for r in STR.read_stats(spark, d).filter("kind <> 'k'").collect()} == {"total": 300, "train": 210, "validation": 45, "test": 45}


def test_stream_keeps_the_first_sighting(spark):
    """Late and out-of-order copies, in runs that go on from each other, give the batch rows; no row is lost."""
    from corpusforge.streaming import stream as STR

    d = tempfile.mkdtemp(prefix="cf-first-", dir="/tmp")
    day = "2025-05-{:02d} 10:00:00".format
    runs = [
        [("u1", 5, "s", "five", day(1)), ("u2", 2, "s", "two", day(1)), ("u1", 7, "s", "seven", day(2)), (None, 1, "s", "none", day(1))],
        [("u1", 3, "s", "three", day(3)), ("u2", 9, "s", "nine", day(3)), ("u3", 4, "s", "four", "soon"), (None, 8, "s", "none", day(3))],
        [("u4", 10, "s", "ten", day(28)), ("u3", 6, "s", "six", day(28))],
        [("u2", 1, "s", "one", day(28)), ("u1", 12, "s", "twelve", day(28)), ("u4", 11, "s", "eleven", day(28))],  # u1 and u2 are forgotten by now
    ]
    schema = "url string, seq bigint, source string, category string, scraped_at string"
    for run in runs:
        spark.createDataFrame(run, schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
        stream = spark.readStream.schema(schema).parquet(f"{d}/in")
        STR.dedupe_to_files(stream, f"{d}/out", "2 days")
    got = sorted(((r.url, r.seq, r.category) for r in STR.read_deduped(spark, f"{d}/out").collect()), key=str)
    assert got == [("u1", 3, "three"), ("u2", 1, "one"), ("u3", 4, "four"), ("u4", 10, "ten"), (None, 1, "none"), (None, 8, "none")]
    assert sorted(r.reason for r in spark.read.parquet(f"{d}/out/unheld").collect()) == ["no url", "no url", "unreadable time"]
    assert spark.read.parquet(f"{d}/out/sightings").count() < 9


def test_stream_state_is_bounded_by_the_cores(spark):
    """the state's partitions, each of which costs every batch time, do not go by the shuffle partitions; the session's settings come back."""
    from corpusforge.streaming import stream as STR

    d = tempfile.mkdtemp(prefix="cf-state-", dir="/tmp")
    rows = [("u1", 2, "s", "two", "2025-05-01 10:00:00"), ("u1", 1, "s", "one", "2025-05-01 11:00:00"), ("u2", None, None, "none", "2025-05-01 10:00:00")]
    schema = "url string, seq bigint, source string, category string, scraped_at string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/in")
    key, most = "spark.sql.shuffle.partitions", max(STR.STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    before = spark.conf.get(key)
    spark.conf.set(key, str(most + 5))
    try:
        STR.dedupe_to_files(spark.readStream.schema(schema).parquet(f"{d}/in"), f"{d}/out", "2 days")
        assert spark.conf.get(key) == str(most + 5)
    finally:
        spark.conf.set(key, before)
    assert 0 < len([x for x in os.listdir(f"{d}/out/checkpoints/sightings/state/0") if x.isdigit()]) <= most
    got = sorted((r.url, r.seq, r.source, r.category) for r in STR.read_deduped(spark, f"{d}/out").collect())
    assert got == [("u1", 1, "s", "one"), ("u2", None, None, "none")]


def test_stream_sightings_batch_by_batch(spark):
    """A batch writes the rows that come before all that is remembered: no copies, late rows too; old windows leave the state."""
    from corpusforge.streaming import stream as STR

    d = tempfile.mkdtemp(prefix="cf-sight-", dir="/tmp")
    day = "2025-05-{:02d} 10:00:00".format
    runs = [
        ([("u1", 5, day(3)), ("u1", 6, day(1)), ("u2", 4, day(3)), ("u3", 7, day(1))], {("u1", 5), ("u2", 4), ("u3", 7)}),
        ([("u1", 8, day(4)), ("u1", 5, day(3)), ("u2", 9, day(4)), ("u2", 6, day(1)), ("u3", 8, day(2))], set()),  # copies only
        ([("u1", 2, day(2)), ("u1", 3, day(4)), ("u3", 8, day(4))], {("u1", 2)}),  # an earlier sighting
        ([("u4", 1, day(30))], {("u4", 1)}),
        ([("u2", 3, day(29)), ("u3", 1, day(30)), ("u4", 2, day(29))], {("u2", 3), ("u3", 1)}),  # late, but within the windows that are open
    ]
    schema = "url string, seq bigint, source string, category string, scraped_at string"
    for k, (run, _) in enumerate(runs):
        spark.createDataFrame([(u, n, "s", "c", at) for u, n, at in run], schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
        STR.dedupe_to_files(spark.readStream.schema(schema).parquet(f"{d}/in"), f"{d}/out", "1 day")
    seen = spark.read.parquet(f"{d}/out/sightings").collect()
    assert sorted((r.url, r.seq) for r in seen) == sorted(x for _, want in runs for x in want)
    assert {(r.url, r.seq) for r in STR.read_deduped(spark, f"{d}/out").collect()} == {("u1", 2), ("u2", 3), ("u3", 1), ("u4", 1)}
    state = spark.read.format("statestore").load(f"{d}/out/checkpoints/sightings")
    assert {r.url for r in state.select("key.url").collect()} == {"u2", "u3", "u4"}  # u1 is forgotten


def test_stream_sightings_of_a_repeated_batch(spark):
    """A batch that was killed after its rows were written, but before it was committed, is done again and replaces its own rows."""
    from corpusforge.streaming import stream as STR

    d = tempfile.mkdtemp(prefix="cf-again-", dir="/tmp")
    schema = "url string, seq bigint, source string, category string, scraped_at string"
    spark.createDataFrame([(f"u{n % 4}", n, "s", "c", "2025-05-01 10:00:00") for n in range(8)], schema).coalesce(1).write.parquet(f"{d}/in")
    for _ in range(2):
        STR.dedupe_to_files(spark.readStream.schema(schema).parquet(f"{d}/in"), f"{d}/out", "1 day")
        assert sorted((r.url, r.seq) for r in spark.read.parquet(f"{d}/out/sightings").collect()) == [(f"u{n}", n) for n in range(4)]
        for name in os.listdir(commits := f"{d}/out/checkpoints/sightings/commits"):
            os.remove(f"{commits}/{name}")


def test_refused_records_are_kept_apart(spark):
    from corpusforge.sources import io

    d = tempfile.mkdtemp(prefix="cf-p3-", dir="/tmp")
    os.makedirs(f"{d}/in")
    files = {"ok": '{"title": "t", "content": "c"}', "null": '{"title": null}', "cut": '{"title": "t"', "list": "[1]", "number": "7", "typed": '{"title": 5}', "nested": '{"content": {"a": 1}}', "empty": ""}
    for name, content in files.items():
        with open(f"{d}/in/{name}.json", "w") as f:
            f.write(content)
    kept, refused = io.sort_raw_json(spark, f"{d}/in", f"{d}/out")
    short = lambda r: os.path.basename(r["_file"]).removesuffix(".json")
    assert sorted(map(short, kept.collect())) == ["null", "ok"] and kept.columns == io.scan_raw_json(spark, f"{d}/in").columns
    got = {short(r): (r.reason, r.value) for r in refused.collect()}
    assert {k: v[0] for k, v in got.items()} | {"empty": ""} == {"cut": "not JSON", "list": "not an object", "number": "not an object", "typed": "title is no text", "nested": "content is no text", "empty": ""}
    assert all(v[1] == files[k] for k, v in got.items()) and len(got) + kept.count() >= len(files) - 1


def test_event_time_is_zone_safe_and_lenient(spark):
    from corpusforge.streaming import stream as STR

    df = spark.createDataFrame([("2025-01-01 07:00:00",), ("not a time",), (None,)], "scraped_at string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Ho_Chi_Minh", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r.e for r in STR.with_scraped_ts(df).select(F.unix_timestamp("scraped_ts").alias("e")).collect()]
            assert got == [1735689600, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("variant,kept", [("a", 24), ("b", 24), ("d", 24)])
def test_build_corpus_end_to_end(spark, raw_dir, variant, kept):
    from corpusforge.plans.corpus import build_corpus

    raw = io.scan_raw_json(spark, raw_dir)
    stats = {}
    for fmt in ("csv", "parquet"):
        d = tempfile.mkdtemp(prefix="cf-corpus-", dir="/tmp")
        os.makedirs(f"{d}/stats/_temporary")  # what a failed run leaves
        res = build_corpus(spark, raw, d, variant=variant, tokenize=True, split_format=fmt)
        assert res.counters["read"] == res.counters["kept"] + res.counters["rejected"] == sum(res.rejects.values())
        assert res.counters["kept"] == kept
        splits = io.read_csv(spark, res.splits_path) if fmt == "csv" else spark.read.parquet(res.splits_path)
        stats[fmt] = {(r.kind, r.key): r.n for r in spark.read.json(res.stats_path).select("kind", "key", "n").collect()}
        clean = spark.read.parquet(res.clean_path)
        assert splits.count() == clean.count() == kept == stats[fmt]["total", ""]
        assert sum(stats[fmt][k, ""] for k in ("train", "validation", "test")) == kept
        assert {r.split: r["count"] for r in splits.groupBy("split").count().collect()} == {k: stats[fmt][k, ""] for k in ("train", "validation", "test")}
        assert sum(n for (kind, _), n in stats[fmt].items() if kind == "sources") == kept
        assert "tokenized_content" in clean.columns
        assert build_corpus(spark, raw, d, variant=variant) is None  # finished: nothing runs
        again = build_corpus(spark, raw.limit(5), d, variant=variant, split_format=fmt, skip_if_done=False)
        assert spark.read.json(again.stats_path).filter("kind = 'total'").first().n <= 5  # not the old document
    assert stats["csv"] == stats["parquet"]


def test_reader_drops_rows_that_do_not_parse(spark, raw_dir):
    raw = io.scan_raw_json(spark, raw_dir)
    assert raw.count() == 28  # neither the corrupt file nor the list for a text
    assert raw.filter("url IS NULL").count() == 2


def test_raw_sink_and_compaction(spark):
    d = tempfile.mkdtemp(prefix="cf-raw-", dir="/tmp")
    df = spark.createDataFrame([("u1", "s1", "c1", "x", "y"), ("u2", "s2", "c2", "x", "y")],
                               "url string, source string, category string, summary string, content string")
    io.write_raw(df, f"{d}/raw")
    back = spark.read.json(f"{d}/raw")
    assert sorted(r.url for r in back.collect()) == ["u1", "u2"]
    assert {r.source for r in back.collect()} == {"s1", "s2"}
    io.compact_raw(back.withColumn("_file", F.lit("f")), f"{d}/compact")
    assert spark.read.parquet(f"{d}/compact").count() == 2


def test_dedupe_by_url_keeps_earliest_and_null_urls(spark, raw_dir):
    raw = io.scan_raw_json(spark, raw_dir)
    d = A.dedupe_by_url(raw)
    assert d.count() == raw.count() - 1 and d.columns == raw.columns
    kept = d.filter("url = 'https://a.vn/0.htm'").collect()
    assert [r.scraped_at for r in kept] == ["2025-05-07 10:00:00"]
    assert d.filter("url IS NULL").count() == 2


def test_local_text_epoch(spark):
    from corpusforge.functions import text as T

    df = spark.createDataFrame([("2025-04-06 18:30:59",)], "s string")
    assert df.select(T.local_text_epoch("s").alias("e")).first().e == 1743939059


@pytest.mark.parametrize("variant", ["a", "b", "c", "d"])
def test_clean_with_reason_matches_operators(spark, raw_dir, variant):
    raw = io.scan_raw_json(spark, raw_dir)
    tagged = A.clean_with_reason(raw, variant)
    kept = sorted((tuple(r) for r in tagged.filter(F.col("reason") == "kept").drop("reason").collect()), key=str)
    op = A.clean_article_a(raw) if variant == "a" else A.clean_article_narrow(raw, variant)
    assert kept == sorted((tuple(r) for r in op.collect()), key=str)
    reasons = {r.reason: r.n for r in tagged.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    head = {"missing_key": 2} if variant == "a" else {"missing_key": 1, "empty_summary": 1}
    assert reasons == {"kept": len(kept), "empty_content": 1, "short_content": 1} | head


def test_union_of_sites(spark):
    a = spark.createDataFrame([("u1", "t1")], "url string, title string")
    b = spark.createDataFrame([("u2", "s2")], "url string, summary string")
    got = {r.url: (r.title, r.summary) for r in A.union_sites(a, b).collect()}
    assert got == {"u1": ("t1", None), "u2": (None, "s2")}


def test_stream_dedupe_drops_late_duplicate_across_batches(spark):
    from corpusforge.streaming import stream as STR

    d = tempfile.mkdtemp(prefix="cf-late-", dir="/tmp")
    src = f"{d}/raw"
    os.makedirs(src)
    rows = [
        ("a_1.json", {"url": "u1", "source": "s", "category": "c", "scraped_at": "2025-05-07 10:00:00",
                      "summary": "x", "content": "first"}),
        ("b_2.json", {"url": "u2", "source": "s", "category": "c", "scraped_at": "2025-05-07 11:00:00",
                      "summary": "x", "content": "other"}),
        ("c_3.json", {"url": "u1", "source": "s", "category": "c", "scraped_at": "2025-05-07 12:00:00",
                      "summary": "x", "content": "late copy"}),
    ]
    import time

    base = time.time() - 3600
    for k, (name, obj) in enumerate(rows):
        path = os.path.join(src, name)
        with open(path, "w", encoding="utf-8") as f:
            json.dump(obj, f, indent=2)
        os.utime(path, (base + 10 * k, base + 10 * k))  # the file source orders by modification time
    stream = STR.read_raw_stream(spark, src, max_files_per_trigger=1)  # one file per micro-batch
    STR.run_to_files(STR.dedupe_stream(stream).drop("scraped_ts"), f"{d}/out", f"{d}/ck")
    got = {(r.url, r.content) for r in spark.read.parquet(f"{d}/out").collect()}
    assert got == {("u1", "first"), ("u2", "other")}


def test_cli_build(spark, raw_dir, capsys):
    from corpusforge.__main__ import main

    d = tempfile.mkdtemp(prefix="cf-cli-", dir="/tmp")
    assert main(["build", "--raw", raw_dir, "--out", f"{d}/c", "--variant", "b", "--dedupe-urls"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["counters"] == {"read": 27, "kept": 23, "rejected": 4}
    assert main(["build", "--raw", raw_dir, "--out", f"{d}/c", "--variant", "b"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["skipped"]
