"""Exact split invariants, stats document, partition independence."""

import math

from pyspark.sql import functions as F

from conftest import SF_MID, needs
from corpusforge.operators import split as G
from corpusforge.operators import stats as ST


def test_split_exact_sizes_and_cover(spark):
    for n in (1, 2, 7, 90, 1000):
        df = spark.range(n).withColumnRenamed("id", "k")
        s = G.split_exact(df, "k").collect()
        assert sorted(r.k for r in s) == list(range(n))
        train, val_end = math.floor(0.7 * n), math.floor(0.85 * n)
        assert [sum(r.split == x for r in s) for x in ("train", "validation", "test")] == [train, val_end - train, n - val_end]
        # the labels follow the seeded order
        order = {r.k: r.pos for r in G.global_rank(df, "k").collect()}
        by = sorted((order[r.k], r.split) for r in s)
        assert [x for _, x in by] == ["train"] * train + ["validation"] * (val_end - train) + ["test"] * (n - val_end)
    assert G.split_exact(spark.range(0).withColumnRenamed("id", "k"), "k").count() == 0


def test_null_and_repeated_keys_are_split_too(spark):
    rows = [(None if i % 3 == 0 else f"u{i % 40}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "url string, n long")
    s = G.split_exact(df, "url", tiebreak=["n"]).collect()
    assert sorted(r.n for r in s) == list(range(200))
    assert [sum(r.split == x for r in s) for x in ("train", "validation", "test")] == [140, 30, 30]


def test_double_cut_points(spark):
    # int(0.7 * 90) is 62 in floating point (63 in exact decimal)
    s = G.split_exact(spark.range(90).withColumnRenamed("id", "k"), "k")
    assert s.filter(F.col("split") == "train").count() == 62


def test_rank_matches_single_sort(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    ranked = G.global_rank(df, "k", prefix_hex=1).select("k", "pos").collect()
    expect = sorted(range(500), key=lambda k: (__import__("hashlib").md5(f"42:{k}".encode()).hexdigest(), k))
    assert [r.k for r in sorted(ranked, key=lambda r: r.pos)] == expect


@needs(SF_MID)
def test_same_result_under_1_and_8_partitions(spark):
    d = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id")
    a = {(r.doc_id, r.split) for r in G.split_exact(d.coalesce(1), "doc_id").collect()}
    b = {(r.doc_id, r.split) for r in G.split_exact(d.repartition(8), "doc_id").collect()}
    assert a == b
    sizes = {r.split: r.n for r in G.split_sizes(d).collect()}
    assert sizes == {"train": 700, "validation": 150, "test": 150, "total": 1000}


def test_stats_document(spark):
    rows = [(i, "s1" if i % 3 else "s2", None if i == 5 else f"c{i % 2}") for i in range(20)]
    df = spark.createDataFrame(rows, "k long, source string, category string")
    st = {(r.kind, r.key): r.n for r in ST.dataset_stats(df).collect()}
    assert st == {("total", ""): 20, ("train", ""): 14, ("validation", ""): 3, ("test", ""): 3, ("sources", "s1"): 13, ("sources", "s2"): 7,
                  ("categories", "c0"): 10, ("categories", "c1"): 9}
    vc = [(r.source, r.n) for r in ST.source_counts(df).collect()]
    assert vc == [("s1", 13), ("s2", 7)]


def test_rank_free_stats_equal_counted_splits(spark):
    rows = [(i, f"s{i % 3}", None if i % 7 == 0 else f"c{i % 4}") for i in range(157)]
    df = spark.createDataFrame(rows, "k long, source string, category string")
    counted = {(r.kind, r.key): r.n for r in ST.stats_grouping_sets(G.split_exact(df, "k")).collect()}
    free = {(r.kind, r.key): r.n for r in ST.dataset_stats(df).collect()}
    assert {k: free[(k, "")] for k in ("train", "validation", "test")} == {k: counted[("split", k)] for k in ("train", "validation", "test")}
    assert all(free[("sources", k)] == n for (kind, k), n in counted.items() if kind == "source")
