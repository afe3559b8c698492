"""Work that goes on over runs: seen URLs and a split that grows."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import html as X
from corpusforge.operators import split as G
from corpusforge.operators.seen import SeenUrls, crawl_run

LINK = "url string, source string, category string"


def _folder(name):
    return tempfile.mkdtemp(prefix=f"cf-{name}-", dir="/tmp")


@pytest.mark.parametrize("blocks", [1 << 10, 1])  # one block: every link is perhaps known, and the answer is the same
def test_seen_urls(spark, blocks):
    seen = SeenUrls(spark, _folder("seen"), blocks)
    links = lambda *names: spark.createDataFrame([(n, "s", "c") for n in names], LINK)
    urls = lambda df: sorted(r.url or "" for r in df.collect())
    assert urls(seen.unseen(links("a", "a", None))) == ["", "a", "a"]
    assert seen.commit(links("a", "b", "b", None)) == 1
    assert urls(seen.unseen(links("a", "c", "c", None, "b"))) == ["", "c", "c"]
    many = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("s").alias("source"), F.lit("c").alias("category"))
    assert seen.commit(many) == 2
    assert seen.unseen(many).count() == 0
    assert SeenUrls(spark, seen.root, blocks).unseen(many.withColumn("url", F.concat("url", F.lit("x")))).count() == 3000


def test_a_dead_run_is_not_counted(spark):
    seen = SeenUrls(spark, _folder("dead"))
    one = spark.createDataFrame([("a", "s", "c")], LINK)
    two = spark.createDataFrame([("b", "s", "c")], LINK)
    seen.commit(one)
    seen.commit(two)
    os.remove(f"{seen.root}/filter/run=2/_SUCCESS")  # died before its end
    assert seen.runs() == [1] and seen.unseen(two).count() == 1 and seen.unseen(one).count() == 0
    assert seen.commit(two) == 2 and seen.unseen(two).count() == 0


def test_the_filter_decides_for_most_new_links(spark):
    """New links hardly ever meet the table of URLs."""
    seen = SeenUrls(spark, _folder("bloom"), 64)
    urls = lambda a, b: spark.range(a, b).select(F.concat(F.lit("http://a.vn/"), "id").alias("url"))
    seen.commit(urls(0, 2000))
    folder = f"{seen.root}/urls"
    os.rename(folder, f"{folder}-away")  # only the filter is left: what it cannot tell is taken for new here
    spark.createDataFrame([], "url string").write.parquet(f"{folder}/run=1")
    assert seen.unseen(urls(0, 2000)).count() == 2000
    tagged = [x for x in os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")) if x.startswith("bloom-")]
    newest = max((f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/{x}" for x in tagged), key=os.path.getmtime)
    assert spark.read.parquet(newest).filter("_maybe").count() == 2000  # no known link is taken for new by the filter
    assert seen.unseen(urls(5000, 7000)).count() == 2000
    tagged = [x for x in os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")) if x.startswith("bloom-")]
    newest = max((f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/{x}" for x in tagged), key=os.path.getmtime)
    assert spark.read.parquet(newest).filter("_maybe").count() < 100


def test_second_crawl_extracts_new_links_only(spark):
    menu = lambda *hrefs: "<nav>" + "".join(f"<a href='{h}'>x</a>" for h in hrefs) + "</nav>"
    page = "<h1>A title of some length</h1><div class='content'><p>" + "word " * 40 + "</p></div>"
    listing = lambda i, *hrefs: spark.createDataFrame([(i, "http://a.vn/cat/l", menu(*hrefs))], "page_id long, url string, html string")
    fetched = spark.createDataFrame([(100 + k, f"http://a.vn/{k}", page) for k in range(5)], "page_id long, url string, html string")
    seen = SeenUrls(spark, _folder("crawl"))
    runs = [crawl_run(seen, listing(i, *hrefs), fetched) for i, hrefs in enumerate([("/0", "/1", "/1"), ("/1", "/2"), ("/0", "/2")])]
    assert [sorted(r.url[-1] for r in links.collect()) for links, _ in runs] == [["0", "1"], ["2"], []]
    assert [sorted(r.page_id for r in articles.collect()) for _, articles in runs] == [[100, 101], [102], []]
    assert runs[0][1].columns == list(X.ARTICLE)


def _labels(rows):
    return sorted((str(r.k), r.t, r.split) for r in rows)


def test_growing_split_equals_the_full_one(spark):
    """Appends of unequal size, null and repeated keys, an append that died; a hot key with a third of all rows."""
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("t"))
    grown = G.GrowingSplit(spark, _folder("split"), "k", tiebreak=["t"])
    bounds, labels = [0, 1, 40, 500, 900], {}
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        part = rows.filter(F.col("t").between(lo, hi - 1))
        if lo == 40:  # an append that dies: its thresholds have no end mark
            number = grown.append(part)
            os.remove(f"{grown.root}/thresholds/append={number}/_SUCCESS")
        number = grown.append(part)
        tie = F.md5(F.to_json(F.struct("t")))
        if number:
            changed = grown.changes(number).collect()
            moved = {(r.key, r.tie): (r.old, r.new) for r in changed}
            assert len(moved) == len(changed)
            for key, (old, new) in moved.items():
                assert labels[key] == old
                labels[key] = new
        labels |= {(r.k, r.tie): r.split for r in grown.label(part.withColumn("tie", tie), number).collect()}
        so_far = rows.filter(F.col("t") < hi).withColumn("tie", tie)
        assert labels == {(r.k, r.tie): r.split for r in G.split_exact(so_far, "k", tiebreak=["t"]).collect()}
    assert grown.appends() == [0, 1, 2, 3]
    sizes = [list(labels.values()).count(x) for x in ("train", "validation", "test")]
    assert sizes == [630, 135, 135]


def test_equal_rows_are_ranked_as_one(spark):
    """Rows equal in key and tie are counted before they are put in order."""
    rows = spark.range(1000).select(F.when(F.col("id") < 990, F.lit(None)).otherwise(F.col("id")).cast("string").alias("k"))
    plan = G.split_exact(rows, "k")._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan
    assert G.split_exact(rows, "k").filter("k IS NULL").select("split").distinct().count() == 1
