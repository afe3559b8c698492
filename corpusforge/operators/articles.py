"""Article-level transforms: required keys (P1), gates (P2), composed cleaners.

All functions are ``DataFrame -> DataFrame`` and compose with ``df.transform``.
Rows carry ``source`` and ``category`` through every variant; narrow
projections happen only at the sinks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import sentences as S
from corpusforge.functions import text as T
from corpusforge.operators.plan_utils import filter_computed

REQUIRED_A = ("title", "summary", "content", "source")
REQUIRED_BCD = ("url", "summary", "content")
WIDE_COLUMNS = ("id", "title", "summary", "content", "pub_date", "category", "url", "source")


# ---------------------------------------------------------------------------
# Test-data adaptor
# ---------------------------------------------------------------------------
def first_line(col) -> Column:
    """Text before the first newline (whole text if none) without splitting every line."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring_index(c, "\n", 1)


def documents_as_articles(docs: DataFrame, summary: str = "empty") -> DataFrame:
    """Present the ``documents`` table as raw wide articles.

    url = ``doc://{doc_id}``, category = lang, title = first line of text,
    content = text; summary is ``''`` (``summary='empty'``) or the first line.
    """
    summ = F.lit("") if summary == "empty" else first_line("text")
    return docs.select(
        "doc_id",
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        first_line("text").alias("title"),
        summ.alias("summary"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("pub_date"),
        F.col("lang").alias("category"),
        "source",
        F.lit(None).cast("string").alias("scraped_at"),
    )


# ---------------------------------------------------------------------------
# P1 / P2 / P3
# ---------------------------------------------------------------------------
def has_keys(df: DataFrame, keys) -> Column:
    """True when every key is present.

    With a ``_keys`` column (exact JSON scan) presence is key membership, so a
    JSON ``null`` counts as present, like a ``dict`` lookup.  Otherwise a null
    column value stands for a missing key.
    """
    if "_keys" in df.columns:
        conds = [F.array_contains("_keys", k) for k in keys]
    else:
        conds = [F.col(k).isNotNull() for k in keys]
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def filter_required(df: DataFrame, keys=REQUIRED_BCD) -> DataFrame:
    """P1."""
    return df.filter(has_keys(df, keys))


def drop_unparsed(df: DataFrame) -> DataFrame:
    """Rows a scan could not parse are dropped (the typed scan has no other failure path)."""
    if "_corrupt_record" in df.columns:
        return df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return df


def quality_a(title: Column, content: Column, content_words: Column) -> Column:
    """P2a on cleaned values."""
    return (title != "") & (content != "") & (content_words >= T.MIN_CONTENT_WORDS)


def quality_b(summary: Column, content: Column, content_words: Column) -> Column:
    """P2b on cleaned values."""
    return (summary != "") & (content != "") & (content_words >= T.MIN_CONTENT_WORDS)


# ---------------------------------------------------------------------------
# Composed cleaners
# ---------------------------------------------------------------------------
CLEANERS = {
    "a": T.clean_a,
    "b": T.clean_b,
    "c": S.clean_c,
    "d": S.clean_d,
}


def cleaner(variant: str, carry_bug: bool = False):
    fn = CLEANERS[variant]
    if variant in ("c", "d"):
        return lambda col: fn(col, carry_bug=carry_bug)
    return fn


def clean_article_a(raw: DataFrame) -> DataFrame:
    """Article operator A: P1 -> clean A (title/summary/content) -> P2a -> T16 -> T17/T18.

    Output: the wide clean schema ``id, title, summary, content, pub_date,
    category, url, source``.
    """
    df = drop_unparsed(raw)
    df = filter_required(df, REQUIRED_A)
    # One projection computes the cleaned values once; the gate reads them.
    df = df.select(
        *[c for c in df.columns if c not in ("title", "summary", "content")],
        T.clean_a("title").alias("title"),
        T.clean_a("summary").alias("summary"),
        T.clean_a("content").alias("content"),
        # A removes characters after collapsing, which can leave double
        # spaces: count words with the general (regex) form.
    ).withColumn("_content_words", T.word_count("content"))
    df = filter_computed(df, quality_a(F.col("title"), F.col("content"), F.col("_content_words")))
    return df.select(
        T.article_id("source", "url").alias("id"),
        "title",
        T.summary_fallback("summary", "content").alias("summary"),
        "content",
        *T.default_fields("pub_date", "category", "url", "source"),
    )


def clean_article_narrow(raw: DataFrame, variant: str, carry_bug: bool = False) -> DataFrame:
    """Article operators B/C/D: P1 -> cleaner on summary/content -> P2b.

    Output ``url, source, category, summary, content``.  (The summary
    fallback is unreachable here: P2b already rejects an empty summary.)
    """
    df = drop_unparsed(raw)
    df = filter_required(df, REQUIRED_BCD)
    df = df.select("url", "source", "category", "summary", "content")
    if variant in ("c", "d"):
        text = T.clean_c_text if variant == "c" else T.clean_d_text
        df = S.with_chunks(df, {"summary": text("summary"), "content": text("content")}, carry_bug=carry_bug)
    else:
        fn = cleaner(variant, carry_bug)
        df = df.withColumns({"summary": fn("summary"), "content": fn("content")})
    df = df.withColumn("_content_words", T.word_count("content"))
    df = filter_computed(df, quality_b(F.col("summary"), F.col("content"), F.col("_content_words")))
    return df.drop("_content_words")


def clean_article_b(raw: DataFrame) -> DataFrame:
    return clean_article_narrow(raw, "b")


def clean_article_c(raw: DataFrame, carry_bug: bool = False) -> DataFrame:
    return clean_article_narrow(raw, "c", carry_bug)


def clean_article_d(raw: DataFrame, carry_bug: bool = False) -> DataFrame:
    return clean_article_narrow(raw, "d", carry_bug)


# ---------------------------------------------------------------------------
# G7 reject reasons
# ---------------------------------------------------------------------------
def reject_reason(df: DataFrame, variant: str = "a", carry_bug: bool = False) -> DataFrame:
    """Every input row with the first rule that rejects it (``kept`` otherwise).

    Reasons in rule order: ``missing_key``, ``empty_title`` (A) /
    ``empty_summary`` (B-D), ``empty_content``, ``short_content``.  Same pass
    as :func:`clean_with_reason` (defined below).
    """
    return clean_with_reason(df, variant, carry_bug)


# ---------------------------------------------------------------------------
# X6 on raw articles (optional): one row per URL, earliest crawl wins
# ---------------------------------------------------------------------------
def dedupe_by_url(raw: DataFrame, order_cols=("scraped_at", "_file")) -> DataFrame:
    """Keep one raw article per ``url``: the one with the smallest
    ``order_cols`` (earliest ``scraped_at``, then file name).  Articles
    without a URL are not copies of each other: all stay.

    ``min_by`` aggregates partially on the map side, so a URL crawled in a
    third of all files costs one partial row per task.
    """
    order = [c for c in order_cols if c in raw.columns] or ["url"]
    cols = [c for c in raw.columns if c != "url"]
    agg = raw.filter("url IS NOT NULL").groupBy("url").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return agg.select("url", "_r.*").select(*raw.columns).unionByName(raw.filter("url IS NULL"))


# ---------------------------------------------------------------------------
# Union of the sites' corpora
# ---------------------------------------------------------------------------
def union_sites(*corpora: DataFrame) -> DataFrame:
    """One corpus of several sites' articles; a column that a site lacks is null there."""
    out = corpora[0]
    for c in corpora[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


REASONS = ("kept", "missing_key", "empty_title", "empty_summary", "empty_content", "short_content")


def clean_with_reason(raw: DataFrame, variant: str, carry_bug: bool = False) -> DataFrame:
    """Every input row cleaned once, with the output columns of the article
    operator of ``variant`` and the first failing rule in ``reason``
    (``kept`` for rows the operator keeps).

    Used by jobs that need both the kept rows and the reject statistics: one
    cleaning pass serves both (filter ``reason == 'kept'`` with
    :func:`filter_computed`).
    """
    df = drop_unparsed(raw)
    if variant == "a":
        keys, head = REQUIRED_A, "title"
        df = df.select(
            *[c for c in df.columns if c not in ("title", "summary", "content")],
            has_keys(df, keys).alias("_ok"),
            T.clean_a("title").alias("title"),
            T.clean_a("summary").alias("summary"),
            T.clean_a("content").alias("content"),
        )
    else:
        keys, head = REQUIRED_BCD, "summary"
        df = df.select("url", "source", "category", has_keys(df, keys).alias("_ok"), "summary", "content")
        if variant in ("c", "d"):
            text = T.clean_c_text if variant == "c" else T.clean_d_text
            df = S.with_chunks(df, {"summary": text("summary"), "content": text("content")}, carry_bug=carry_bug)
        else:
            df = df.withColumns({"summary": T.clean_b("summary"), "content": T.clean_b("content")})
    df = df.withColumn("_words", T.word_count("content"))
    reason = (
        F.when(~F.col("_ok"), "missing_key")
        .when(F.col(head) == "", "empty_title" if variant == "a" else "empty_summary")
        .when(F.col("content") == "", "empty_content")
        .when(F.col("_words") < T.MIN_CONTENT_WORDS, "short_content")
        .otherwise("kept")
    )
    df = df.withColumn("reason", reason)
    if variant == "a":
        return df.select(
            T.article_id("source", "url").alias("id"),
            "title",
            T.summary_fallback("summary", "content").alias("summary"),
            "content",
            *T.default_fields("pub_date", "category", "url", "source"),
            "reason",
        )
    return df.select("url", "source", "category", "summary", "content", "reason")
