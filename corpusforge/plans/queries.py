"""Query registry: one Spark job per operator, each with its DuckDB oracle.

Every query reads the driver tables (``documents``, ``pages``, ...) from
``sf_dir`` and runs over whole tables and whole texts.  Column names are
aliased identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import sentences as S
from corpusforge.functions import text as T
from corpusforge.operators import articles as A
from corpusforge.operators import split as G
from corpusforge.operators import stats as ST
from corpusforge.operators.plan_utils import explode_computed, filter_computed, materialize
from corpusforge.operators import html as X
from corpusforge.operators.seen import SeenUrls, crawl_run
from corpusforge.operators import segment as U
from corpusforge.operators import tokens as W
from corpusforge.plans import oracle_sql as Q
from corpusforge.plans.corpus import build_corpus
from corpusforge.session import scratch_path
from corpusforge.sources import csv_blocks, io, raw_files
from corpusforge.sources.io import read_table
from corpusforge.streaming import stream as STR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------
# T*: scalar text rules over documents.text
# ---------------------------------------------------------------------------
_SCALAR = {
    "strip_tags": (T.strip_tags, Q.strip_tags),
    "collapse_ws": (T.collapse_ws, Q.collapse_ws),
    "whitelist_chars": (T.whitelist_chars, Q.whitelist),
    "newline_to_period": (T.newline_to_period, Q.nl_period),
    "newline_to_space": (T.newline_to_space, Q.nl_space),
    "strip_quotes": (T.strip_quotes, Q.quotes),
    "strip_photo_credit": (T.strip_photo_credit, Q.photo),
    "strip_dateline": (T.strip_dateline, Q.dateline),
    "strip_promo": (T.strip_promo, Q.promo),
    "repair_brand": (T.repair_brand, Q.brand),
    "unify_terminators": (T.unify_terminators, Q.terminators),
    "newline_to_period_d": (T.newline_to_period_d, Q.nl_period_d),
    "newline_to_space_d": (T.newline_to_space_d, Q.nl_space_d),
    "collapse_dots": (T.collapse_dots, Q.dots),
    "clean_a": (T.clean_a, Q.clean_a),
    "clean_b": (T.clean_b, Q.clean_b),
}


def _scalar_query(fn):
    def q(spark, sf_dir):
        d = table(spark, sf_dir, "documents")
        return d.select("doc_id", fn(T.null_to_empty("text")).alias("out"))

    return q


for _name, (_spark_fn, _sql_fn) in _SCALAR.items():
    register(_name, f"SELECT doc_id, {_sql_fn(Q.nz('text'))} AS out FROM documents")(_scalar_query(_spark_fn))


@register("word_count", f"SELECT doc_id, {Q.word_count('text')} AS n_words FROM documents")
def q_word_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.word_count("text").alias("n_words"))


@register(
    "summary_fallback",
    f"SELECT doc_id, array_to_string({Q.words('text')}[1:50], ' ') AS summary FROM documents",
)
def q_summary_fallback(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.summary_fallback(F.lit(""), T.null_to_empty("text")).alias("summary"))


@register(
    "article_id",
    "SELECT doc_id, concat_ws('_', coalesce(source, ''), md5('doc://' || CAST(doc_id AS VARCHAR))) AS id "
    "FROM documents",
)
def q_article_id(spark, sf_dir):
    a = A.documents_as_articles(table(spark, sf_dir, "documents"))
    return a.select("doc_id", T.article_id("source", "url").alias("id"))


@register(
    "default_fields",
    f"SELECT doc_id, coalesce(pub_date, '') AS pub_date, coalesce(category, '') AS category, "
    f"coalesce(url, '') AS url, coalesce(source, '') AS source FROM ({Q.articles_view()})",
)
def q_default_fields(spark, sf_dir):
    a = A.documents_as_articles(table(spark, sf_dir, "documents"))
    return a.select("doc_id", *T.default_fields("pub_date", "category", "url", "source"))


# ---------------------------------------------------------------------------
# C / D cleaners (with the sentence re-packer)
# ---------------------------------------------------------------------------
def _chunked(variant: str, carry_bug: bool):
    text = T.clean_c_text if variant == "c" else T.clean_d_text

    def q(spark, sf_dir):
        d = table(spark, sf_dir, "documents").select("doc_id", "text")
        return S.with_chunks(d, {"out": text("text")}, carry_bug=carry_bug).select("doc_id", "out")

    return q


register("clean_c", Q.clean_c("documents", "doc_id", "text", "doc_id", "out"))(_chunked("c", False))
register("clean_d", Q.clean_d("documents", "doc_id", "text", "doc_id", "out"))(_chunked("d", False))
register("clean_c_carry_bug", Q.clean_c("documents", "doc_id", "text", "doc_id", "out", carry_bug=True))(
    _chunked("c", True)
)
register("clean_d_carry_bug", Q.clean_d("documents", "doc_id", "text", "doc_id", "out", carry_bug=True))(
    _chunked("d", True)
)


# ---------------------------------------------------------------------------
# P*: required keys, gates
# ---------------------------------------------------------------------------
@register(
    "filter_required",
    f"SELECT doc_id, url FROM ({Q.articles_view('first_line')}) "
    "WHERE url IS NOT NULL AND summary IS NOT NULL AND content IS NOT NULL",
)
def q_filter_required(spark, sf_dir):
    a = A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line")
    return A.filter_required(a, A.REQUIRED_BCD).select("doc_id", "url")


@register(
    "filter_quality_a",
    f"""WITH a AS (SELECT doc_id, {Q.clean_a('title')} AS title, {Q.clean_a('content')} AS content
                   FROM ({Q.articles_view()}) WHERE title IS NOT NULL AND summary IS NOT NULL
                   AND content IS NOT NULL AND source IS NOT NULL)
SELECT doc_id, {Q.word_count('content')} AS n_words FROM a
WHERE title <> '' AND content <> '' AND {Q.word_count('content')} >= 50""",
)
def q_filter_quality_a(spark, sf_dir):
    a = A.filter_required(A.documents_as_articles(table(spark, sf_dir, "documents")), A.REQUIRED_A)
    c = a.select("doc_id", T.clean_a("title").alias("title"), T.clean_a("content").alias("content"))
    c = c.withColumn("n_words", T.word_count("content"))
    return filter_computed(c, A.quality_a(F.col("title"), F.col("content"), F.col("n_words"))).select(
        "doc_id", "n_words"
    )


@register(
    "filter_quality_b",
    f"""WITH a AS (SELECT doc_id, {Q.clean_b('summary')} AS summary, {Q.clean_b('content')} AS content
                   FROM ({Q.articles_view('first_line')}) WHERE url IS NOT NULL AND summary IS NOT NULL
                   AND content IS NOT NULL)
SELECT doc_id, {Q.word_count('content')} AS n_words FROM a
WHERE summary <> '' AND content <> '' AND {Q.word_count('content')} >= 50""",
)
def q_filter_quality_b(spark, sf_dir):
    a = A.filter_required(
        A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line"), A.REQUIRED_BCD
    )
    c = a.select("doc_id", T.clean_b("summary").alias("summary"), T.clean_b("content").alias("content"))
    c = c.withColumn("n_words", T.spaced_word_count("content"))
    return filter_computed(c, A.quality_b(F.col("summary"), F.col("content"), F.col("n_words"))).select(
        "doc_id", "n_words"
    )


# ---------------------------------------------------------------------------
# Composed article operators
# ---------------------------------------------------------------------------
def clean_article_a_sql(src: str | None = None) -> str:
    src = src or f"({Q.articles_view()})"
    return f"""WITH r AS (SELECT * FROM {src} WHERE title IS NOT NULL AND summary IS NOT NULL
                      AND content IS NOT NULL AND source IS NOT NULL),
c AS (SELECT url, source, category, pub_date, {Q.clean_a('title')} AS title,
             {Q.clean_a('summary')} AS summary, {Q.clean_a('content')} AS content FROM r),
g AS (SELECT * FROM c WHERE title <> '' AND content <> '' AND {Q.word_count('content')} >= 50)
SELECT concat_ws('_', coalesce(source, ''), md5(coalesce(url, ''))) AS id, title,
       CASE WHEN summary = '' THEN array_to_string({Q.words('content')}[1:50], ' ') ELSE summary END AS summary,
       content, coalesce(pub_date, '') AS pub_date, coalesce(category, '') AS category,
       coalesce(url, '') AS url, coalesce(source, '') AS source
FROM g"""


register("clean_article_a", clean_article_a_sql())(
    lambda spark, sf_dir: A.clean_article_a(A.documents_as_articles(table(spark, sf_dir, "documents")))
)

register(
    "clean_article_b",
    f"""WITH r AS (SELECT * FROM ({Q.articles_view('first_line')}) WHERE url IS NOT NULL AND summary IS NOT NULL
                      AND content IS NOT NULL),
c AS (SELECT url, source, category, {Q.clean_b('summary')} AS summary, {Q.clean_b('content')} AS content FROM r)
SELECT url, source, category, summary, content FROM c
WHERE summary <> '' AND content <> '' AND {Q.word_count('content')} >= 50""",
)(
    lambda spark, sf_dir: A.clean_article_b(
        A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line")
    )
)


def _narrow_sql(variant: str) -> str:
    text_fn = Q.clean_c_text if variant == "c" else Q.clean_d_text
    src = (
        f"(SELECT * FROM ({Q.articles_view('first_line')}) WHERE url IS NOT NULL AND summary IS NOT NULL "
        "AND content IS NOT NULL)"
    )
    summ = Q.chunked_text_sql(src, "url", text_fn("summary"), "url", "summary")
    cont = Q.chunked_text_sql(src, "url", text_fn("content"), "url", "content")
    return f"""WITH sm AS ({summ}), ct AS ({cont}), r AS {src}
SELECT r.url, r.source, r.category, sm.summary, ct.content
FROM r JOIN sm ON r.url = sm.url JOIN ct ON r.url = ct.url
WHERE sm.summary <> '' AND ct.content <> '' AND {Q.word_count('ct.content')} >= 50"""


register("clean_article_c", _narrow_sql("c"))(
    lambda spark, sf_dir: A.clean_article_c(
        A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line")
    )
)
register("clean_article_d", _narrow_sql("d"))(
    lambda spark, sf_dir: A.clean_article_d(
        A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line")
    )
)


# ---------------------------------------------------------------------------
# N*: sentences
# ---------------------------------------------------------------------------
@register(
    "split_sentences",
    f"""WITH c AS (SELECT doc_id, {Q.sentences(Q.clean_c_text('text'))} AS ss FROM documents)
SELECT doc_id, CAST(generate_subscripts(ss, 1) AS BIGINT) AS pos, unnest(ss) AS sentence FROM c""",
)
def q_split_sentences(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return explode_computed(d, S.split_sentences(T.clean_c_text("text")), ["doc_id"], "pos", "sentence")


@register(
    "chunk_sentences",
    f"""WITH {Q.chunk_pieces_cte('documents', 'doc_id', Q.clean_c_text('text'))}
SELECT k AS doc_id, row_number() OVER (PARTITION BY k ORDER BY i, j) AS pos, piece FROM pieces""",
)
def q_chunk_sentences(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    p = S.with_chunks(d, {"pieces": T.clean_c_text("text")}, joined=False)
    return explode_computed(p, F.col("pieces"), ["doc_id"], "pos", "piece")


@register(
    "sentence_count",
    f"SELECT doc_id, CAST(len({Q.sentences(Q.clean_c_text('text'))}) AS BIGINT) AS n_sentences FROM documents",
)
def q_sentence_count(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", S.sentence_count(T.clean_c_text("text")).alias("n_sentences"))


@register(
    "long_sentences",
    f"""WITH c AS (SELECT doc_id, {Q.sentences('coalesce(text, \'\')', collapsed=False)} AS ss FROM documents),
u AS (SELECT doc_id, CAST(generate_subscripts(ss, 1) AS BIGINT) AS pos, unnest(ss) AS sentence FROM c)
SELECT doc_id, pos, {Q.word_count('sentence')} AS n_words, CAST(length(sentence) AS BIGINT) AS n_chars
FROM u WHERE {Q.word_count('sentence')} > {S.LONG_SENTENCE_WORDS}""",
)
def q_long_sentences(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    u = explode_computed(d, S.split_sentences("text", collapsed=False), ["doc_id"], "pos", "sentence")
    u = u.withColumn("n_words", T.word_count("sentence"))
    return filter_computed(u, F.col("n_words") > S.LONG_SENTENCE_WORDS).select(
        "doc_id", "pos", "n_words", F.char_length("sentence").cast("bigint").alias("n_chars")
    )


# ---------------------------------------------------------------------------
# G*: shuffle, split, statistics
# ---------------------------------------------------------------------------
@register(
    "shuffle_order",
    f"SELECT doc_id, row_number() OVER (ORDER BY {Q.md5_key('doc_id')}, doc_id) AS pos FROM documents",
)
def q_shuffle_order(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return G.global_rank(d, "doc_id").select("doc_id", "pos")


_SPLIT_DOCS_SQL = f"""SELECT doc_id, source, lang AS category,
  {Q.split_case(f"row_number() OVER (ORDER BY {Q.md5_key('doc_id')}, doc_id)", "count(*) OVER ()")} AS split
FROM documents"""


@register("split_exact", f"SELECT doc_id, split FROM ({_SPLIT_DOCS_SQL})")
def q_split_exact(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return G.split_exact(d, "doc_id").select("doc_id", "split")


@register("split_appended", f"SELECT doc_id, split FROM ({_SPLIT_DOCS_SQL})")
def q_split_appended(spark, sf_dir):
    """G2 under appends: the documents in four parts; each part is labelled when it comes, and later only changed labels are replaced."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    grown, labels = G.GrowingSplit(spark, _out(spark, "split"), "doc_id"), None
    for part in range(4):
        rows = d.filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == part)
        number = grown.append(rows)
        new = grown.label(rows, number)
        if labels is not None:
            changed = grown.changes(number).select(F.col("key").cast("bigint").alias("doc_id"), F.col("new"))
            old = labels.join(changed, "doc_id", "left").select("doc_id", F.coalesce("new", "split").alias("split"))
            new = old.unionByName(new)
        labels = materialize(new, "labels")
    return labels


@register(
    "split_hash",
    f"""SELECT doc_id, CASE WHEN u < 0.7::DOUBLE THEN 'train' WHEN u < 0.85::DOUBLE THEN 'validation' ELSE 'test' END AS split
FROM (SELECT doc_id, CAST(('0x' || substr({Q.md5_key('doc_id')}, 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0 AS u FROM documents)""",
)
def q_split_hash(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return G.split_hash(d, "doc_id").select("doc_id", "split")


@register(
    "split_sizes",
    f"""SELECT split, count(*) AS n FROM ({_SPLIT_DOCS_SQL}) GROUP BY split
UNION ALL SELECT 'total' AS split, count(*) AS n FROM documents""",
)
def q_split_sizes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return G.split_sizes(d)


def _clean_a_articles(spark, sf_dir):
    return A.clean_article_a(A.documents_as_articles(table(spark, sf_dir, "documents")))


_A_SQL = clean_article_a_sql()


@register(
    "source_counts",
    f"SELECT source, count(*) AS n FROM ({_A_SQL}) WHERE source IS NOT NULL GROUP BY source",
)
def q_source_counts(spark, sf_dir):
    return ST.source_counts(_clean_a_articles(spark, sf_dir))


@register(
    "category_counts",
    f"SELECT category, count(*) AS n FROM ({_A_SQL}) WHERE category IS NOT NULL GROUP BY category",
)
def q_category_counts(spark, sf_dir):
    return ST.category_counts(_clean_a_articles(spark, sf_dir))


def _split_articles_sql() -> str:
    return f"""SELECT *, {Q.split_case(f"row_number() OVER (ORDER BY {Q.md5_key('id')}, id)", "count(*) OVER ()")} AS split
FROM ({_A_SQL})"""


_GS_SQL = f"""SELECT CASE WHEN grouping(split) = 0 THEN 'split' WHEN grouping(source) = 0 THEN 'source'
            WHEN grouping(category) = 0 THEN 'category' ELSE 'total' END AS kind,
       coalesce(CASE WHEN grouping(split) = 0 THEN split WHEN grouping(source) = 0 THEN source
                     WHEN grouping(category) = 0 THEN category END, '') AS key,
       count(*) AS n,
       (grouping(source) = 0 AND source IS NULL) OR (grouping(category) = 0 AND category IS NULL) AS _null
FROM ({_split_articles_sql()})
GROUP BY GROUPING SETS ((split), (source), (category), ())"""


def _split_articles(spark, sf_dir):
    # the exact split reads its input several times: clean once, and write
    # only what the statistics read
    kept = _clean_a_articles(spark, sf_dir).select("id", "source", "category")
    return G.split_exact(materialize(kept, "clean-a"), "id")


@register("stats_grouping_sets", f"SELECT kind, key, n FROM ({_GS_SQL}) WHERE NOT _null")
def q_stats_grouping_sets(spark, sf_dir):
    return ST.stats_grouping_sets(_split_articles(spark, sf_dir))


@register(
    "dataset_stats",
    f"""SELECT CASE kind WHEN 'split' THEN key WHEN 'source' THEN 'sources' WHEN 'category' THEN 'categories'
                 ELSE 'total' END AS kind,
       CASE WHEN kind IN ('source', 'category') THEN key ELSE '' END AS key, n
FROM ({_GS_SQL}) WHERE NOT _null""",
)
def q_dataset_stats(spark, sf_dir):
    # split sizes follow from the row count: no ranking, one aggregate pass
    return ST.dataset_stats(_clean_a_articles(spark, sf_dir))


def _reasons_sql(src: str, ok: str, head: str, head_name: str, content: str) -> str:
    return f"""SELECT CASE WHEN NOT ({ok}) THEN 'missing_key' WHEN {head} = '' THEN '{head_name}' WHEN {content} = '' THEN 'empty_content'
            WHEN {Q.word_count(content)} < 50 THEN 'short_content' ELSE 'kept' END AS reason, count(*) AS n
FROM {src} GROUP BY 1"""


def _reasons_chunked_sql(variant: str) -> str:
    text_fn = Q.clean_c_text if variant == "c" else Q.clean_d_text
    src = f"({Q.articles_view('first_line')})"
    return f"""WITH sm AS ({Q.chunked_text_sql(src, 'url', text_fn('summary'), 'url', 's')}),
ct AS ({Q.chunked_text_sql(src, 'url', text_fn('content'), 'url', 'c')}),
j AS (SELECT r.*, s, c FROM {src} r JOIN sm USING (url) JOIN ct USING (url))
{_reasons_sql('j', 'url IS NOT NULL AND summary IS NOT NULL AND content IS NOT NULL', 's', 'empty_summary', 'c')}"""


_REASONS_SQL = {
    "a": _reasons_sql(f"(SELECT *, {Q.clean_a('title')} AS t, {Q.clean_a('content')} AS c FROM ({Q.articles_view()}))",
                      "title IS NOT NULL AND summary IS NOT NULL AND content IS NOT NULL AND source IS NOT NULL", "t", "empty_title", "c"),
    "b": _reasons_sql(f"(SELECT *, {Q.clean_b('summary')} AS s, {Q.clean_b('content')} AS c FROM ({Q.articles_view('first_line')}))",
                      "url IS NOT NULL AND summary IS NOT NULL AND content IS NOT NULL", "s", "empty_summary", "c"),
    "c": _reasons_chunked_sql("c"),
    "d": _reasons_chunked_sql("d"),
}


def _reject_reasons(variant: str):
    def q(spark, sf_dir):
        a = A.documents_as_articles(table(spark, sf_dir, "documents"), summary="empty" if variant == "a" else "first_line")
        return ST.reject_counts(A.clean_with_reason(a, variant))

    return q


for _v, _sql in _REASONS_SQL.items():
    register("reject_reasons" if _v == "a" else f"reject_reasons_{_v}", _sql)(_reject_reasons(_v))


@register(
    "union_sites",
    f"""SELECT source, title, summary, category, url FROM ({Q.articles_view('first_line')}) WHERE source = 'src0'
UNION ALL SELECT source, NULL AS title, summary, category, url FROM ({Q.articles_view('first_line')}) WHERE source IS DISTINCT FROM 'src0'""",
)
def q_union_sites(spark, sf_dir):
    """Two sites' corpora, one without titles, as one."""
    a = A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line").select("source", "title", "summary", "category", "url")
    return A.union_sites(a.filter("source = 'src0'"), a.filter("NOT source <=> 'src0'").drop("title"))


# ---------------------------------------------------------------------------
# Flagship: documents -> article A -> exact split -> counts by split/category
# ---------------------------------------------------------------------------
def corpus_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_articles(spark, sf_dir).groupBy("split", "category").agg(F.count(F.lit(1)).alias("n"))


register(
    "corpus_build",
    f"SELECT split, category, count(*) AS n FROM ({_split_articles_sql()}) GROUP BY split, category",
)(corpus_build)


# ---------------------------------------------------------------------------
# X*: extraction from pages
# ---------------------------------------------------------------------------
_CLEAN = Q.html_noise("html")
_LINKS_SQL = f"""SELECT page_id, url, CAST(generate_subscripts(hs, 1) AS BIGINT) AS pos, unnest(hs) AS href
FROM (SELECT page_id, url, {Q.hrefs(Q.element_inner(_CLEAN, 'nav'))} AS hs FROM pages)"""
# the test pages' places of the fields that sites keep elsewhere
PAGE_FIELDS = X.Fields(title=("h1",), summary=("div.ad",), pub_date=("footer",), content=("article p",))


@register("extract_links", f"SELECT page_id, pos, href FROM ({_LINKS_SQL})")
def q_extract_links(spark, sf_dir):
    return X.extract_links(table(spark, sf_dir, "pages")).select("page_id", "pos", "href")


@register("filter_link_suffix", f"SELECT page_id, pos, href FROM ({_LINKS_SQL}) WHERE ends_with(href, 'e')")
def q_filter_link_suffix(spark, sf_dir):
    return X.filter_link_suffix(X.extract_links(table(spark, sf_dir, "pages")), "e").select("page_id", "pos", "href")


_ABS_SQL = f"""SELECT page_id, pos, {Q.absolutize('href', Q.page_base('url'))} AS link,
  {Q.page_source('url')} AS source, {Q.page_category('url')} AS category FROM ({_LINKS_SQL})"""


@register("absolutize_links", f"SELECT page_id, pos, link FROM ({_ABS_SQL})")
def q_absolutize_links(spark, sf_dir):
    return X.absolutize_links(X.extract_links(table(spark, sf_dir, "pages"))).select("page_id", "pos", "link")


@register("distinct_links_per_page", f"SELECT DISTINCT page_id, href FROM ({_LINKS_SQL})")
def q_distinct_links_per_page(spark, sf_dir):
    return X.distinct_links_per_page(table(spark, sf_dir, "pages"))


_DEDUPE_SQL = f"""SELECT link AS url, source, category FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS rn FROM ({_ABS_SQL})) WHERE rn = 1"""


@register("dedupe_links_first", _DEDUPE_SQL)
def q_dedupe_links_first(spark, sf_dir):
    return X.dedupe_links_first(X.page_links(table(spark, sf_dir, "pages")))


@register(
    "extract_card_links",
    f"""SELECT page_id, CAST(generate_subscripts(hs, 1) AS BIGINT) AS pos, unnest(hs) AS href FROM (
  SELECT page_id, list_transform(list_distinct_in_order, lambda x: x) AS hs FROM (
    SELECT page_id, list_filter(hs, lambda h, i: list_position(hs, h) = i) AS list_distinct_in_order
    FROM (SELECT page_id, {Q.hrefs(Q.element_inner(_CLEAN, 'nav'))} AS hs FROM pages)))""",
)
def q_extract_card_links(spark, sf_dir):
    """X2 with the menu entries of the test pages as cards."""
    return X.extract_card_links(table(spark, sf_dir, "pages"), cards=("nav li",), links=("a.item-title", "li > a", "a")).select("page_id", "pos", "href")


@register("extract_title", f"SELECT page_id, {Q.element_text_or_null(_CLEAN, 'h1')} AS title FROM pages")
def q_extract_title(spark, sf_dir):
    return X.extract_field(table(spark, sf_dir, "pages"), X.title_text, "title")


_BODY_SQL = Q.paragraphs(Q.element_inner(_CLEAN, "article"))
_SUMMARY_SQL = f"coalesce({Q.py_strip(Q.inner_text(Q.element_inner(_CLEAN, 'div', 'ad')))}, '')"
_TIME_SQL = f"coalesce({Q.element_text_or_null(_CLEAN, 'footer')}, '')"


@register("extract_body", f"SELECT page_id, {_BODY_SQL} AS content FROM pages")
def q_extract_body(spark, sf_dir):
    return X.extract_field(table(spark, sf_dir, "pages"), X.body_text, "content", X.BODY_SELECTORS + PAGE_FIELDS.content)


@register("extract_summary", f"SELECT page_id, {_SUMMARY_SQL} AS summary FROM pages")
def q_extract_summary(spark, sf_dir):
    return X.extract_field(table(spark, sf_dir, "pages"), X.summary_text, "summary", X.SUMMARY_SELECTORS + PAGE_FIELDS.summary)


@register("extract_pub_time", f"SELECT page_id, {_TIME_SQL} AS pub_date FROM pages")
def q_extract_pub_time(spark, sf_dir):
    return X.extract_field(table(spark, sf_dir, "pages"), X.time_text, "pub_date", X.TIME_SELECTORS + PAGE_FIELDS.pub_date)


@register(
    "extract_strict",
    f"""SELECT page_id, url, {Q.inner_text(Q.element_inner(_CLEAN, 'div', 'ad'))} AS summary,
  {Q.inner_text(Q.element_inner(_CLEAN, 'footer'))} AS content FROM pages""",
)
def q_extract_strict(spark, sf_dir):
    return X.extract_strict(table(spark, sf_dir, "pages"), ("div.ad", "footer"))


@register(
    "extract_strict_nested",
    f"""SELECT page_id, url, {Q.py_strip(Q.inner_text(Q.element_inner(Q.element_inner(_CLEAN, 'article'), 'h1')))} AS summary,
  {Q.py_strip(Q.inner_text(Q.element_inner(Q.element_inner(_CLEAN, 'nav'), 'ul')))} AS content FROM pages""",
)
def q_extract_strict_nested(spark, sf_dir):
    return X.extract_strict(table(spark, sf_dir, "pages"), ("article h1", "nav ul"), strip=True)


#: Some letters of the documents' languages and their names, which are also valid without a semicolon.
_NAMED = {"é": "eacute", "à": "agrave", "ñ": "ntilde", "ü": "uuml", "ß": "szlig", "ö": "ouml", "ä": "auml", "ó": "oacute", "ç": "ccedil", "í": "iacute"}


@register("decode_references", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
def q_decode_references(spark, sf_dir):
    """X8 on texts written with references: named (with a semicolon or without), decimal and hexadecimal; the text comes back."""

    def written(c, i):
        named = F.lit(None).cast("string")
        for letter, name in _NAMED.items():
            named = F.when(c == letter, F.lit(f"&{name}")).otherwise(named)
        number = F.when(i % 2 == 0, F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(F.concat(F.lit("&#x"), F.hex(F.ascii(c)), F.lit(";")))
        other = F.when(F.ascii(c) >= 160, F.when(i % 3 > 0, F.concat(named, F.when(i % 3 == 1, ";").otherwise(""))))
        return F.coalesce(other, F.when(c == "&", "&amp;").when(c == "<", "&lt;").when(F.ascii(c) >= 160, number).otherwise(c))

    d = table(spark, sf_dir, "documents").select("doc_id", T.null_to_empty("text").alias("text"))
    chars = d.select("doc_id", F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0)).alias("c"))
    pages = chars.select("doc_id", F.concat(F.lit("<h1>"), F.array_join(F.transform("c", written), ""), F.lit("</h1>")).alias("html"))
    return X.with_tree(pages).select("doc_id", X.select_text("_tree", "h1").alias("text"))


_FIELDS_SQL = f"""SELECT page_id, url, {Q.element_text_or_null(_CLEAN, 'h1')} AS title,
  {_SUMMARY_SQL} AS summary, {_BODY_SQL} AS content, {_TIME_SQL} AS pub_date FROM pages"""
_GATE = f"title IS NOT NULL AND length(title) >= 10 AND {Q.word_count('content')} >= 30"


@register("gate_pages", f"SELECT page_id, url, title, content FROM ({_FIELDS_SQL}) WHERE {_GATE}")
def q_gate_pages(spark, sf_dir):
    return X.gate_pages(table(spark, sf_dir, "pages"), PAGE_FIELDS)


@register(
    "pages_to_articles",
    f"""SELECT page_id, title, summary, content, pub_date, {Q.page_category('url')} AS category, url,
  {Q.page_source('url')} AS source, '1970-01-01 07:00:00' AS scraped_at FROM ({_FIELDS_SQL}) WHERE {_GATE}""",
)
def q_pages_to_articles(spark, sf_dir):
    return X.pages_to_articles(table(spark, sf_dir, "pages"), fields=PAGE_FIELDS)


# Test-data adaptor: every page also stands for the fetched target of the last
# link of its own menu, so that listing links lead to pages of the table.
_FETCHED_SQL = f"SELECT page_id, max_by(link, pos) AS url FROM ({_ABS_SQL}) GROUP BY page_id"


def _fetched(pages: DataFrame) -> DataFrame:
    menu = X.with_tree(pages).select("page_id", "url", "html", X.links_in("_tree").alias("_menu"))
    return menu.select("page_id", X.absolutize(F.get("_menu", F.size("_menu") - 1), X.page_base("url")).alias("url"), "html")


@register(
    "join_links_pages",
    f"SELECT p.url, d.source, d.category, p.page_id FROM ({_DEDUPE_SQL}) d JOIN ({_FETCHED_SQL}) p ON d.url = p.url",
)
def q_join_links_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = X.dedupe_links_first(X.page_links(pages))
    return X.join_links_pages(links, _fetched(pages)).select("url", "source", "category", "page_id")


@register(
    "links_to_articles",
    f"""SELECT f.page_id, f.title, f.summary, f.content, f.pub_date, d.category, p.url, d.source, '1970-01-01 07:00:00' AS scraped_at
FROM ({_DEDUPE_SQL}) d JOIN ({_FETCHED_SQL}) p ON d.url = p.url JOIN ({_FIELDS_SQL}) f ON f.page_id = p.page_id WHERE {_GATE}""",
)
def q_links_to_articles(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return X.links_to_articles(pages, _fetched(pages), PAGE_FIELDS)


_HALF = "(SELECT (min(page_id) + max(page_id)) // 2 FROM pages)"


@register(
    "links_across_runs",
    f"""SELECT link AS url, source, category, CASE WHEN page_id <= {_HALF} THEN 1 ELSE 2 END AS run FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS rn FROM ({_ABS_SQL})) WHERE rn = 1""",
)
def q_links_across_runs(spark, sf_dir):
    """X6 across runs: the first half of the pages, the second, and the first again (which meets nothing new)."""
    pages = table(spark, sf_dir, "pages")
    cut = pages.agg(F.floor((F.min("page_id") + F.max("page_id")) / 2)).first()[0]
    halves = [pages.filter(F.col("page_id") <= cut), pages.filter(F.col("page_id") > cut)]
    seen, runs = SeenUrls(spark, _out(spark, "seen")), []
    for k, half in enumerate([*halves, halves[0]], 1):
        links = materialize(seen.unseen(X.dedupe_links_first(X.page_links(half))), "new-links")
        seen.commit(links)
        runs.append(links.withColumn("run", F.lit(k)))
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@register(
    "articles_across_runs",
    f"""WITH r AS (SELECT link AS url, source, category, CASE WHEN page_id <= {_HALF} THEN 1 ELSE 2 END AS run FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS rn FROM ({_ABS_SQL})) WHERE rn = 1)
SELECT f.page_id, f.title, f.content, r.category, p.url, r.source, r.run FROM r JOIN ({_FETCHED_SQL}) p ON r.url = p.url JOIN ({_FIELDS_SQL}) f ON f.page_id = p.page_id WHERE {_GATE}""",
)
def q_articles_across_runs(spark, sf_dir):
    """X16 over two runs: the second one extracts only pages that its new links lead to."""
    pages = table(spark, sf_dir, "pages")
    cut = pages.agg(F.floor((F.min("page_id") + F.max("page_id")) / 2)).first()[0]
    seen = SeenUrls(spark, _out(spark, "seen"))
    first, second = (crawl_run(seen, half, _fetched(pages), PAGE_FIELDS)[1] for half in (pages.filter(F.col("page_id") <= cut), pages.filter(F.col("page_id") > cut)))
    both = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return both.select("page_id", "title", "content", "category", "url", "source", "run")


# ---------------------------------------------------------------------------
# W*: tokenisation and the compound lexicon
# ---------------------------------------------------------------------------
_W_SQL = "[\\p{L}\\p{N}_]"
_TOKEN_SQL = f"{_W_SQL}+(?:[.,\\-/]{_W_SQL}+)*|[^\\p{{L}}\\p{{N}}_{Q.WS_BODY}]"
_WORD_TOKEN_SQL = f"^{_W_SQL}+(?:[.,\\-/]{_W_SQL}+)*$"


def _tok_sql(x: str) -> str:
    return f"regexp_extract_all({Q.nz(x)}, {Q.lit(_TOKEN_SQL)})"


@register(
    "tokenize_columns",
    f"""SELECT id, array_to_string({_tok_sql('title')}, ' ') AS tokenized_title,
       array_to_string({_tok_sql('summary')}, ' ') AS tokenized_summary,
       array_to_string({_tok_sql('content')}, ' ') AS tokenized_content FROM ({_A_SQL})""",
)
def q_tokenize_columns(spark, sf_dir):
    return W.tokenize_columns(_clean_a_articles(spark, sf_dir)).select(
        "id", "tokenized_title", "tokenized_summary", "tokenized_content"
    )


_TOKS_SQL = f"SELECT {_tok_sql('text')} AS t FROM documents"
def _wt(x: str) -> str:
    return f"regexp_full_match({x}, {Q.lit(_WORD_TOKEN_SQL)})"


@register(
    "bigram_lexicon",
    f"""WITH tk AS ({_TOKS_SQL}),
uni AS (SELECT w, count(*) AS n FROM (SELECT unnest(t) AS w FROM tk) WHERE {_wt('w')} GROUP BY w),
tot AS (SELECT sum(n) AS N FROM uni),
pr AS (SELECT t[i] AS w1, t[i + 1] AS w2 FROM (SELECT t, unnest(range(1, len(t))) AS i FROM tk)),
bi AS (SELECT w1, w2, count(*) AS n12 FROM pr WHERE {_wt('w1')} AND {_wt('w2')} GROUP BY w1, w2
       HAVING count(*) >= {W.MIN_COUNT})
SELECT bi.w1, bi.w2, bi.n12, u1.n AS n1, u2.n AS n2
FROM bi JOIN uni u1 ON bi.w1 = u1.w JOIN uni u2 ON bi.w2 = u2.w, tot
WHERE CAST(bi.n12 AS HUGEINT) * CAST(tot.N AS HUGEINT) >= {W.PMI_RATIO} * CAST(u1.n AS HUGEINT) * CAST(u2.n AS HUGEINT)""",
)
def q_bigram_lexicon(spark, sf_dir):
    return W.bigram_lexicon(table(spark, sf_dir, "documents"))


def _level_sql(k: int) -> str:
    """Compounds of k words, from those of k - 1 (``c{k-1}``)."""
    gram = " || ' ' || ".join(f"t[i + {j}]" for j in range(k))
    words = " AND ".join(_wt(f"t[i + {j}]") for j in range(k))
    part = lambda a, b: " || ' ' || ".join(f"t[i + {j}]" for j in range(a, b))
    return f"""g{k} AS (SELECT {gram} AS compound, {part(0, k - 1)} AS head, {part(1, k)} AS tail, t[i + {k - 1}] AS last, count(*) AS n
       FROM (SELECT t, unnest(range(1, len(t) - {k - 2})) AS i FROM tk) WHERE {words} GROUP BY ALL HAVING count(*) >= {W.MIN_COUNT}),
c{k} AS (SELECT g{k}.compound, g{k}.n FROM g{k} JOIN c{k - 1} h ON g{k}.head = h.compound JOIN c{k - 1} e ON g{k}.tail = e.compound JOIN uni u ON g{k}.last = u.w, tot
       WHERE CAST(g{k}.n AS HUGEINT) * CAST(tot.N AS HUGEINT) >= {W.PMI_RATIO} * CAST(h.n AS HUGEINT) * CAST(u.n AS HUGEINT))"""


@register(
    "compound_lexicon",
    f"""WITH tk AS ({_TOKS_SQL}),
uni AS (SELECT w, count(*) AS n FROM (SELECT unnest(t) AS w FROM tk) WHERE {_wt('w')} GROUP BY w),
tot AS (SELECT sum(n) AS N FROM uni),
c2 AS (SELECT w1 || ' ' || w2 AS compound, n12 AS n FROM ({SQL["bigram_lexicon"]})),
{_level_sql(3)}, {_level_sql(4)}
SELECT compound, 2 AS words, n FROM c2 UNION ALL SELECT compound, 3, n FROM c3 UNION ALL SELECT compound, 4, n FROM c4""",
)
def q_compound_lexicon(spark, sf_dir):
    """W2 beyond pairs: compounds of up to four words, level by level."""
    return W.compound_lexicon(table(spark, sf_dir, "documents"))


_MERGE_SQL = f"""WITH lex AS ({SQL["bigram_lexicon"]}),
tk AS (SELECT doc_id, {_tok_sql('text')} AS t FROM documents),
u AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM tk),
p AS (SELECT doc_id, i, w, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS w_next FROM u),
h AS (SELECT p.*, lex.w1 IS NOT NULL AS hit FROM p LEFT JOIN lex ON p.w = lex.w1 AND p.w_next = lex.w2),
s AS (SELECT *, CASE WHEN hit AND NOT coalesce(lag(hit) OVER (PARTITION BY doc_id ORDER BY i), false)
                     THEN i END AS st FROM h),
r AS (SELECT *, max(st) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM s),
x AS (SELECT *, hit AND (i - run) % 2 = 0 AS used FROM r),
y AS (SELECT *, coalesce(lag(used) OVER (PARTITION BY doc_id ORDER BY i), false) AS glued FROM x),
m AS (SELECT doc_id, string_agg(CASE WHEN used THEN w || '_' || w_next ELSE w END, ' ' ORDER BY i) AS text
      FROM y WHERE NOT glued GROUP BY doc_id)
SELECT d.doc_id, coalesce(m.text, '') AS text FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id"""


@register("compound_merge", _MERGE_SQL)
def q_compound_merge(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lex = W.bigram_lexicon(d)
    return W.merge_compounds(d, lex, "doc_id")


@register("segment_words")  # no SQL: tested against all segmentations of small texts
def q_segment_words(spark, sf_dir):
    """W1 with a unigram segmenter learnt from the same corpus, over the compounds of W2."""
    d = table(spark, sf_dir, "documents")
    model, _ = U.learn(d)
    return U.segment(d, model, "doc_id")


# ---------------------------------------------------------------------------
# ST*: incremental jobs (file stream over the documents folder)
# ---------------------------------------------------------------------------
def _docs_stream(spark, sf_dir):
    """The documents table, a file or a folder of them, a few files per micro-batch."""
    return STR.read_table_stream(spark, f"{sf_dir.rstrip('/')}/documents.parquet", max_files_per_trigger=4)


@register("stream_clean_article_b", SQL["clean_article_b"])
def q_stream_clean_article_b(spark, sf_dir):
    articles = A.documents_as_articles(_docs_stream(spark, sf_dir), summary="first_line")
    return STR.stream_to_table(A.clean_article_b(articles), "st1")


def _sighted(spark, sf_dir) -> DataFrame:
    """The documents as sightings: a text's digest is its URL, doc_id the order; event times within two days, out of order."""
    return _docs_stream(spark, sf_dir).select(
        F.md5(F.coalesce("text", F.lit(""))).alias("url"), F.col("doc_id").alias("seq"), "source", F.col("lang").alias("category"),
        F.concat(F.lit("2025-01-0"), (1 + F.col("doc_id") % 2).cast("string"), F.lit(" "), F.lpad((F.col("doc_id") * 7 % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("scraped_at"))


@register("stream_dedupe_text", """SELECT url, seq, source, category, true AS seen FROM (
  SELECT md5(coalesce(text, '')) AS url, doc_id AS seq, source, lang AS category, row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY doc_id) AS k FROM documents) WHERE k = 1""")
def q_stream_dedupe_text(spark, sf_dir):
    """ST2 on documents: each text once, with the attributes of its first sighting by doc_id, whatever the order of arrival."""
    root = _out(spark, "st2")
    STR.dedupe_to_files(_sighted(spark, sf_dir), root, "3 days")
    return STR.read_deduped(spark, root).withColumn("seen", F.lit(True))


@register("stream_unheld", "SELECT CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id::VARCHAR END AS url, doc_id AS seq, CASE WHEN doc_id % 3 = 0 THEN 'no url' ELSE 'unreadable time' END AS reason FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0")
def q_stream_unheld(spark, sf_dir):
    """ST2's side output: rows without URL, and rows whose time cannot be read, none of which is lost."""
    rows = _sighted(spark, sf_dir).withColumns({
        "url": F.when(F.col("seq") % 3 > 0, F.col("seq").cast("string")),
        "scraped_at": F.when(F.col("seq") % 5 > 0, F.col("scraped_at")).otherwise("yesterday"),
    })
    return STR.stream_to_table(STR.unheld(rows).select("url", "seq", "reason"), "st2-unheld")


_RUNNING = "SELECT source, lang AS category, count(*) AS n FROM documents GROUP BY source, lang"


def _counted(spark, sf_dir, kinds: dict) -> str:
    run = _out(spark, "st3")
    STR.run_counts(_docs_stream(spark, sf_dir).withColumn("category", F.col("lang")), f"{run}/counts", f"{run}/checkpoint", kinds)
    return f"{run}/counts"


@register("stream_running_counts", _RUNNING)
def q_stream_running_counts(spark, sf_dir):
    """ST3: counts per source and category, maintained batch by batch."""
    both = F.to_json(F.struct("source", "category"))
    path = _counted(spark, sf_dir, {"both": both})
    rows = STR.read_counts(spark, path).filter("kind = 'both'").select(F.from_json("key", "source string, category string").alias("k"), "n")
    return rows.select("k.*", "n")


@register(
    "raw_file_names",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS scraped_at,
       event_type || '_' || CAST(CAST(floor(epoch(ts)) AS BIGINT) - 25200 AS VARCHAR) || '_' || CAST(user_id AS VARCHAR) || '.json' AS file_name
FROM events""",
)
def q_raw_file_names(spark, sf_dir):
    """A crawl time as text, and the raw file name ``{source}_{epoch}_{category}.json`` made from it."""
    e = table(spark, sf_dir, "events").select("event_id", T.format_scraped_at("ts").alias("scraped_at"), "event_type", F.col("user_id").cast("string").alias("user"))
    return e.select("event_id", "scraped_at", T.raw_file_name("event_type", T.local_text_epoch("scraped_at"), "user").alias("file_name"))


# ---------------------------------------------------------------------------
# S* / K*: what a sink wrote, read again by the matching scan
# ---------------------------------------------------------------------------
def _out(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _raw_articles(spark, sf_dir) -> DataFrame:
    a = A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line")
    return a.select("url", "source", "category", "title", "summary", "content")


def _save_files(rows: DataFrame, path: str) -> None:
    """``source, category, value`` as one raw file each; a writer's rows have one epoch each, so their names differ."""
    raw_files.save(rows.withColumn("epoch", F.monotonically_increasing_id()), path)


_RAW_SQL = f"SELECT url, source, category, title, summary, content FROM ({Q.articles_view('first_line')})"
# an empty CSV field reads back as null
_RAW_CSV_SQL = "SELECT url, source, category, nullif(title, '') AS title, nullif(summary, '') AS summary, nullif(content, '') AS content FROM (" + _RAW_SQL + ")"


@register("raw_sink_scan", _RAW_SQL)
def q_raw_sink_scan(spark, sf_dir):
    """K1 and S1 (line by line): raw articles in folders by source and category."""
    path = _out(spark, "k1")
    io.write_raw(_raw_articles(spark, sf_dir), path)
    back = spark.read.schema("url string, title string, summary string, content string, source string, category string").json(path)
    return back.select("url", "source", "category", "title", "summary", "content")


@register("json_dir_scan", f"SELECT url, source, summary, content, content IS NOT NULL AS has_content FROM ({Q.articles_view('first_line')})")
def q_json_dir_scan(spark, sf_dir):
    """A folder of JSON objects, one article per file, each file parsed whole with its keys."""
    path = _out(spark, "s1")
    a = _raw_articles(spark, sf_dir)
    _save_files(a.select("source", "category", F.to_json(F.struct(*a.columns)).alias("value")), path)
    back = io.scan_raw_json(spark, path)
    return back.select("url", "source", "summary", "content", F.array_contains("_keys", "content").alias("has_content"))


@register(
    "dead_letters",
    """WITH d AS (SELECT CASE WHEN doc_id % 7 = 0 THEN 'not JSON' WHEN doc_id % 11 = 0 THEN 'content is no text' WHEN doc_id % 13 = 0 THEN 'not an object' END AS reason FROM documents)
SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM d GROUP BY 1 UNION ALL SELECT 'read', count(*) FROM d""",
)
def q_dead_letters(spark, sf_dir):
    """Raw files, some of them unreadable, sorted into articles and refused records in one pass; kept + refused = read."""
    path, sorted_path = _out(spark, "p3"), _out(spark, "p3-sorted")
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("category"),
                                                 F.to_json(F.struct(F.col("text").alias("content"), "source"), {"ignoreNullFields": "false"}).alias("j"))
    bad = F.when(F.col("doc_id") % 7 == 0, F.expr("left(j, length(j) - 1)")).when(F.col("doc_id") % 11 == 0, '{"content": ["a list"]}').when(F.col("doc_id") % 13 == 0, F.concat(F.lit("["), F.col("j"), F.lit("]")))
    _save_files(d.select("source", "category", F.coalesce(bad, F.col("j")).alias("value")), path)
    kept, refused = io.sort_raw_json(spark, path, sorted_path)
    both = kept.select(F.lit("kept").alias("reason")).unionByName(refused.select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return both.unionByName(spark.read.schema("refused boolean").parquet(sorted_path).agg(F.count(F.lit(1)).alias("n")).select(F.lit("read").alias("reason"), "n"))


@register("csv_sink_scan", _RAW_CSV_SQL)
def q_csv_sink_scan(spark, sf_dir):
    """The processed corpus as CSV; the first existing of two paths is read."""
    path = _out(spark, "k2")
    io.write_csv(_raw_articles(spark, sf_dir), path)
    schema = "url string, source string, category string, title string, summary string, content string"
    return io.read_first_existing(spark, [f"{path}-tokenised", path], schema)


@register("csv_block_scan", _RAW_CSV_SQL)
def q_csv_block_scan(spark, sf_dir):
    """The same corpus read by blocks, so that every file is shared by several tasks."""
    path = _out(spark, "s2-blocks")
    io.write_csv(_raw_articles(spark, sf_dir), path)
    return csv_blocks.read_csv_blocks(spark, path, "url string, source string, category string, title string, summary string, content string", block=4 << 20)


@register("raw_files_scan", "SELECT source, 1700000000 + doc_id AS epoch, lang AS category, text AS content, doc_id % 1000 < 500 AS early FROM documents")
def q_raw_files_scan(spark, sf_dir):
    """S1 and K1 through the data source: a file per article, read back in two scans by time, from the files' names."""
    path = _out(spark, "raw-files")
    d = table(spark, sf_dir, "documents")
    raw_files.save(d.select("source", (F.lit(1_700_000_000) + F.col("doc_id")).alias("epoch"), F.col("lang").alias("category"),
                            F.to_json(F.struct(F.col("text").alias("content"))).alias("value")), path)
    cut = 1_700_000_500
    halves = raw_files.scan(spark, path, until=cut).unionByName(raw_files.scan(spark, path, since=cut))
    return halves.select("source", "epoch", "category", F.from_json("value", "content string").content.alias("content"),
                         ((F.col("epoch") - 1_700_000_000) % 1000 < 500).alias("early"))


@register("links_sink_scan", f"SELECT url, source, category FROM ({_DEDUPE_SQL})")
def q_links_sink_scan(spark, sf_dir):
    """K3: the link list as CSV."""
    path = _out(spark, "k3")
    io.write_links_csv(X.dedupe_links_first(X.page_links(table(spark, sf_dir, "pages"))), path)
    return io.read_csv(spark, path, "url string, source string, category string")


@register("tokenised_sink_scan", f"SELECT doc_id, nullif(array_to_string({_tok_sql('text')}, ' '), '') AS tokenized_content FROM documents")
def q_tokenised_sink_scan(spark, sf_dir):
    """K4: the tokenised corpus as CSV."""
    path = _out(spark, "k4")
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    io.write_csv(W.tokenize_columns(d).select("doc_id", "tokenized_content"), path)
    return io.read_csv(spark, path, "doc_id bigint, tokenized_content string")


@register("splits_sink_scan", f"SELECT doc_id, source, nullif(text, '') AS text, split FROM ({_SPLIT_DOCS_SQL}) JOIN (SELECT doc_id, text FROM documents) USING (doc_id)")
def q_splits_sink_scan(spark, sf_dir):
    """K5: the three splits in one CSV folder, texts with quotes, commas and line breaks."""
    path = _out(spark, "k5")
    io.write_splits(G.split_exact(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id"), path)
    return io.read_csv(spark, path, "doc_id bigint, source string, text string, split string")


@register(
    "stats_sink_scan",
    """SELECT 'sources' AS kind, source AS key, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'categories', lang, count(*) FROM documents WHERE lang IS NOT NULL GROUP BY lang
UNION ALL SELECT 'total', '', count(*) FROM documents
UNION ALL SELECT 'train', '', CAST(floor(0.7::DOUBLE * count(*)) AS BIGINT) FROM documents
UNION ALL SELECT 'validation', '', CAST(floor(0.85::DOUBLE * count(*)) - floor(0.7::DOUBLE * count(*)) AS BIGINT) FROM documents
UNION ALL SELECT 'test', '', CAST(count(*) - floor(0.85::DOUBLE * count(*)) AS BIGINT) FROM documents""",
)
def q_stats_sink_scan(spark, sf_dir):
    """K6 and K7: the statistics as JSON, marked as done once written whole."""
    path = _out(spark, "k6")
    assert not io.is_done(spark, path)
    io.write_stats(ST.dataset_stats(table(spark, sf_dir, "documents").select("source", F.col("lang").alias("category"))), path)
    assert io.is_done(spark, path)
    return spark.read.schema("kind string, key string, n bigint").json(path)


@register("stream_dataset_stats", SQL["stats_sink_scan"])
def q_stream_dataset_stats(spark, sf_dir):
    """G3-G6 maintained by a stream: each batch adds its partial counts, compacted before they are read."""
    path = _counted(spark, sf_dir, {"sources": F.col("source"), "categories": F.col("category")})
    STR.compact_counts(spark, path)
    return STR.read_stats(spark, path)


@register("incremental_scan", f"SELECT url, source, category, title FROM ({Q.articles_view('first_line')})")
def q_incremental_scan(spark, sf_dir):
    """Raw JSON files picked up by a stream."""
    path = _out(spark, "s4")
    a = _raw_articles(spark, sf_dir).select("url", "source", "category", "title")
    a.write.json(path)
    stream = STR.read_raw_stream(spark, path, multi_line=False).select("url", "source", "category", "title")
    return STR.stream_to_table(stream, "s4-sink")


# ---------------------------------------------------------------------------
# The end-to-end job
# ---------------------------------------------------------------------------
_SPLIT_D = f"""SELECT *, {Q.split_case(f"row_number() OVER (ORDER BY {Q.md5_key('url')}, url)", "count(*) OVER ()")} AS split FROM ({SQL['clean_article_d']})"""


@register(
    "corpus_stats_end_to_end",
    f"""WITH s AS ({_SPLIT_D})
SELECT 'split' AS kind, split AS key, count(*) AS n FROM s GROUP BY split
UNION ALL SELECT 'sources', source, count(*) FROM s WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'categories', category, count(*) FROM s WHERE category IS NOT NULL GROUP BY category
UNION ALL SELECT 'total', '', count(*) FROM s
UNION ALL SELECT 'kept', '', count(*) FROM s
UNION ALL SELECT 'read', '', count(*) FROM documents""",
)
def q_corpus_stats_end_to_end(spark, sf_dir):
    """build_corpus to its sinks; splits counted from the split files, the rest from the statistics and counters."""
    out = _out(spark, "corpus")
    raw = A.documents_as_articles(table(spark, sf_dir, "documents"), summary="first_line")
    res = build_corpus(spark, raw, out, variant="d")
    splits = io.read_csv(spark, res.splits_path, None).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    stats = spark.read.schema("kind string, key string, n bigint").json(res.stats_path).filter("kind IN ('total', 'sources', 'categories')")
    counters = spark.createDataFrame([(k, "", res.counters[k]) for k in ("read", "kept")], stats.schema)
    return splits.select(F.lit("split").alias("kind"), F.col("split").alias("key"), "n").unionByName(stats).unionByName(counters)
