"""W1 tokenisation and W2 lexicon / compound merge against brute force."""

import math
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from corpusforge.functions import tokens as TK
from corpusforge.operators import tokens as W


def test_tokenize_detaches_punctuation(spark):
    df = spark.createDataFrame([("Giá 1.000 đồng, (VTV.vn) tăng!",), (None,)], "s string")
    got = [r.t for r in df.select(TK.tokenize("s").alias("t")).collect()]
    assert got == ["Giá 1.000 đồng , ( VTV.vn ) tăng !", ""]


def test_custom_tokenizer_hook(spark):
    df = spark.createDataFrame([("a b",), (None,)], "s string")
    got = [r.t for r in df.select(TK.tokenize("s", tokenizer=lambda x: [x.upper()]).alias("t")).collect()]
    assert got == ["A B", ""]


def test_lexicon_brute_force(spark):
    import re

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lex = {(r.w1, r.w2): (r.n12, r.n1, r.n2) for r in W.bigram_lexicon(docs, min_count=3).collect()}
    word = re.compile(r"^[^\W]+(?:[.,\-/][^\W]+)*$")
    toks = [r.t for r in docs.select(TK.tokens("text").alias("t")).collect()]
    uni, bi = Counter(), Counter()
    for t in toks:
        uni.update(w for w in t if word.match(w))
        bi.update((a, b) for a, b in zip(t, t[1:]) if word.match(a) and word.match(b))
    n = sum(uni.values())
    expect = {k: (c, uni[k[0]], uni[k[1]]) for k, c in bi.items() if c >= 3 and c * n >= 8 * uni[k[0]] * uni[k[1]]}
    assert lex == expect and len(expect) > 0


def test_merge_compounds_brute_force(spark):
    texts = spark.createDataFrame([(1, "a b c d e"), (2, "a b a b c"), (3, "x y, a b"), (4, "")], "k long, text string")
    lex = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y")], "w1 string, w2 string")
    more = texts.unionByName(spark.createDataFrame([(None, "z a b"), (None, "b c"), (2, "c d"), (5, None)], texts.schema))
    for size in (W.MAX_PAIRS, 0):  # the lexicon with every task, and as a table
        got = {r.k: r.text for r in W.merge_compounds(texts, lex, "k", max_pairs=size).collect()}
        assert got == {1: "a_b c_d e", 2: "a_b a_b c", 3: "x_y , a_b", 4: ""}
        got = sorted((str(r.k), r.text) for r in W.merge_compounds(more, lex, "k", max_pairs=size).collect())
        assert got == [("1", "a_b c_d e"), ("2", "a_b a_b c"), ("2", "c_d"), ("3", "x_y , a_b"), ("4", ""), ("5", ""), ("None", "b_c"), ("None", "z a_b")]


def _brute_compounds(texts, max_words, min_count, ratio):
    """Level by level, over lists of tokens."""
    word = lambda w: w[0].isalnum()
    uni = Counter(w for t in texts for w in t if word(w))
    n, levels = sum(uni.values()), [{(w,): c for w, c in uni.items()}]
    for k in range(2, max_words + 1):
        grams = Counter(tuple(t[i:i + k]) for t in texts for i in range(len(t) - k + 1) if all(map(word, t[i:i + k])))
        below = levels[-1]
        levels.append({g: c for g, c in grams.items() if c >= min_count and g[:-1] in below and g[1:] in below and c * n >= ratio * below[g[:-1]] * uni[g[-1]]})
    return {" ".join(g): c for level in levels[1:] for g, c in level.items()}


def test_compounds_of_more_words(spark):
    import random

    rng = random.Random(4)
    phrases = ["ho chi minh city", "new york", "new york city", "uy ban nhan dan", "a", "b", "c", "d , e", "chi minh"]
    texts = [" ".join(rng.choice(phrases) for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["", "one", ", ,"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "k long, text string")
    for limits in ((4, 3, 2), (3, 1, 1), (2, 5, 8)):
        got = W.compound_lexicon(df, "text", *limits).collect()
        want = _brute_compounds([t.split() for t in texts], *limits)
        assert {r.compound: r.n for r in got} == want and all(len(r.compound.split()) == r.words for r in got)
    assert W.longest_compounds("x new york city ho chi minh".split(), {"new york", "new york city", "chi minh"}) == ["x", "new_york_city", "ho", "chi_minh"]
    lex = spark.createDataFrame([("new york",), ("new york city",)], "compound string")
    got = {r.k: r.text for r in W.merge_longest(df.filter("k > 59").unionByName(spark.createDataFrame([(100, "old new york city, new york")], df.schema)), lex, "k").collect()}
    assert got[100] == "old new_york_city , new_york" and got[60] == "" and got[99] == ""


def test_compounds_with_every_task_and_as_a_table(spark):
    """Only stretches of compounds are counted for longer ones; punctuation, joined words, any white space and long runs keep their counts."""
    words = ["ho", "chi", "minh", "city", "1.000", "a-b", "x", "y"]
    texts = [" ".join(words[(i + j * (1 + i % 3)) % 8] for j in range(i % 13)) for i in range(200)]
    texts += ["ho　chi\t \nminh city, x", "ho chi. minh city", "(ho chi minh) city", "a-b- 1.000 x", "", ", ,", " ".join(["ho", "chi", "minh"] * 2_000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "k long, text string")
    toks = [r.t for r in df.select(TK.tokens("text").alias("t")).collect()]
    for limits in ((4, 3, 1), (3, 2, 2)):
        want = _brute_compounds(toks, *limits)
        assert any(c.count(" ") == limits[0] - 1 for c in want)
        for size in (W.MAX_PAIRS, 0):
            assert {r.compound: r.n for r in W.compound_lexicon(df, "text", *limits, max_pairs=size).collect()} == want
    runs = df.select(F.explode(F.transform(TK.runs("text"), TK.spaced)).alias("r")).groupBy("r").count().collect()
    assert sum(len(r.r.split(" ")) * r["count"] for r in runs) == sum(w[0].isalnum() for t in toks for w in t)


def test_pairs_match_whole_runs(spark):
    """Pairs of words beside any white space, none across punctuation; no token is tested by itself."""
    rows = [("a\u3000b\x1cc  d",), ("1.000 a-b, a-b- x",), ("",), (None,), (", .",), ("a b a b",)]
    counts = W.pair_counts(spark.createDataFrame(rows, "text string"))
    want = {("a", "b"): 3, ("b", "c"): 1, ("c", "d"): 1, ("d", None): 1, ("1.000", "a-b"): 1, ("a-b", None): 2, ("x", None): 1, ("b", "a"): 1, ("b", None): 1}
    assert {(r.w, r.w_next): r.n for r in counts.collect()} == want
    assert "rlike" not in counts._jdf.queryExecution().optimizedPlan().toString().lower()
