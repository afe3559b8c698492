"""Plan-shape regressions: the physical plans keep the properties the design relies on."""

import __spark_entry__ as E
from conftest import SF_MID, needs


def _plan(spark, name):
    return E.queries()[name](spark, SF_MID)._jdf.queryExecution().executedPlan().toString()


def _filters_below_exchange(plan):
    """Filter lines that sit below some Exchange (deeper indentation)."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1:]:
                if (len(below) - len(below.lstrip(" :+-"))) <= depth:
                    break
                if below.lstrip(" :+-").startswith("Filter"):
                    out.append(below)
    return out


@needs(SF_MID)
def test_article_a_cleans_each_column_once(spark):
    plan = _plan(spark, "clean_article_a")
    # title and content: one tag-strip each (the adaptor's summary is the
    # constant '' and its cleaning is constant-folded away)
    assert plan.count("(?d)<.*?>") == 2


@needs(SF_MID)
def test_no_regex_pushed_below_exchange(spark):
    for name in ("clean_article_a", "clean_article_c", "chunk_sentences", "gate_pages", "extract_links"):
        for f in _filters_below_exchange(_plan(spark, name)):
            assert "regexp" not in f and "exists(" not in f, (name, f[:200])


@needs(SF_MID)
def test_exact_split_shuffles_no_rows(spark):
    from corpusforge.operators import split as G

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    plan = G.split_exact(docs, "doc_id")._jdf.queryExecution().executedPlan().toString()
    head = plan.split("Subquery", 1)[0]
    assert "text" in head and "Exchange" not in head  # labels are projected
    assert not any("text#" in line for line in plan.splitlines() if "Exchange" in line)


@needs(SF_MID)
def test_no_round_robin_shuffle(spark):
    for name in ("clean_article_a", "extract_links", "split_exact", "bigram_lexicon", "reject_reasons"):
        assert "RoundRobinPartitioning" not in _plan(spark, name)


@needs(SF_MID)
def test_lexicon_has_no_cartesian_join(spark):
    plan = _plan(spark, "bigram_lexicon")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@needs(SF_MID)
def test_dedupe_aggregates_partially(spark):
    assert "partial_min_by" in _plan(spark, "dedupe_links_first")
