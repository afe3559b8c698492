"""The re-packer on hand-computed cases (FIXTURES section 6) and by its invariants; whole documents are checked by the SQL oracles."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, needs
from corpusforge.functions import sentences as S
from corpusforge.functions import text as T


def _words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


def _sentence(sizes, sep=", "):
    parts, k = [], 0
    for n in sizes:
        parts.append(_words(n, k))
        k += n
    return sep.join(parts)


CASES = [
    ([128], [128], [128]),
    ([129], [128, 1], [128, 1]),
    ([300], [128, 128, 44], [128, 128, 44]),
    ([60] * 5, [120, 179, 120], [120, 60, 120]),
    ([3, 300, 2], [3, 130, 128, 44, 2], [3, 128, 128, 44, 2]),
    ([100, 30], [100, 129], [100, 30]),
    ([100, 27, 2], [127, 128], [127, 2]),
    ([100, 27, 1], [128], [128]),
]


@pytest.mark.parametrize("sizes,bug,nobug", CASES)
def test_fixture_piece_sizes(spark, sizes, bug, nobug):
    df = spark.createDataFrame([(_sentence(sizes),)], "t string")
    for flag, expect in ((True, bug), (False, nobug)):
        pieces = df.select(S.chunk_pieces("t", carry_bug=flag).alias("p")).first().p
        assert [len(p.split()) for p in pieces] == expect


def test_trailing_comma_and_bare_comma(spark):
    df = spark.createDataFrame([(_sentence([128]) + ",",), (_sentence([100, 27, 2], sep=","),)], "t string")
    got = [len(r.p) for r in df.select(S.chunk_pieces("t").alias("p")).collect()]
    assert got == [1, 1]


def test_empty_parts_survive(spark):
    s = "a,,b, " + _words(200)
    df = spark.createDataFrame([(s,)], "t string")
    pieces = df.select(S.chunk_pieces("t").alias("p")).first().p
    assert [len(p.split()) for p in pieces] == [3, 128, 72]
    assert pieces[0] == "a, , b"


def test_join_pieces(spark):
    df = spark.createDataFrame([("a b. c",), ("",), (" . . ",)], "t string")
    got = [r.o for r in df.select(S.fit_to_max_words("t").alias("o")).collect()]
    assert got == ["a b. c. ", "", ""]


@needs(SF_MID)
def test_chunker_invariants_on_documents(spark):
    d = spark.read.parquet(f"{SF_MID}/documents.parquet").select(T.clean_c_text("text").alias("t"))
    rows = S.with_chunks(d, {"p": F.col("t")}, joined=False).select("t", "p").collect()
    bare = lambda s: s.replace(",", " ").replace(".", " ").split()
    for r in rows:
        assert bare(" ".join(r.p)) == bare(r.t)  # every word once, in order
        assert all(len(p.split()) <= 128 for p in r.p)
        short = [x.strip() for x in r.t.split(".") if x.strip() and len(x.split()) <= 128]
        assert [p for p in r.p if p in set(short)] == short  # short sentences stay as they are


@needs(SF_MID)
def test_cleaned_text_has_no_newline(spark):
    d = spark.read.parquet(f"{SF_MID}/documents.parquet")
    n = d.select(S.clean_c("text").alias("c"), S.clean_d("text").alias("d"), T.clean_a("text").alias("a"),
                 T.clean_b("text").alias("b"))
    assert n.filter(F.col("a").contains("\n") | F.col("b").contains("\n") | F.col("c").contains("\n")
                    | F.col("d").contains("\n")).count() == 0


@needs(SF_MID)
def test_cleaning_independent_of_partitioning(spark):
    from corpusforge.operators import articles as A

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    one = A.clean_article_c(A.documents_as_articles(docs.coalesce(1), "first_line")).collect()
    eight = A.clean_article_c(A.documents_as_articles(docs.repartition(8), "first_line")).collect()
    assert sorted(one) == sorted(eight) and len(one) == 958
