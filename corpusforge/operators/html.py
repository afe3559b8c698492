"""Extraction from tables of HTML pages.

Every page is read once, into a column of numbered elements
(:func:`corpusforge.functions.elements.page_tree`); all selectors of all fields are
expressions over that column.  An element lies inside another if its number lies in the
other's range, so a step of a selector is a filter by tag and classes and a
comparison of numbers, in document order.  A page's list of marks rules out
selectors whose tags or classes it does not have at all.

Pages are independent, so extraction is narrow (no shuffle); only link dedupe
(X6) and the link->page join (X16) shuffle, and neither moves HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.functions.elements import page_tree
from corpusforge.operators.plan_utils import explode_computed, filter_computed, materialize

# ---------------------------------------------------------------------------
# Selector lists of the original extractors.
# ---------------------------------------------------------------------------
CARD_SELECTORS = (
    "article.item-news", ".box-subcate-style4 .item", ".box-subcate-style3 .item", ".box-subcate-style2 .item",
    ".box-subcate-style1 .item", ".item-news", ".vnn-card", ".box-category-item", ".box-subcate-style5 .item",
    ".box-subcate-style6 .item", ".box-subcate-style7 .item", ".list-content .item", ".list-content article",
)
CARD_LINK_SELECTORS = (
    "a.item-title", "a.title-news", "h3.title-news > a", "h3 > a", "a.vnn-title", ".title > a", ".title a",
    ".title-news a", ".vnn-title-top > a", ".vnn-title-top a", 'a[data-medium="Item-1"]', "a",
)
TITLE_SELECTORS = (
    "h1.content-detail-title", "h1.title-detail", "h1.title", "h1.vnn-title", "h1", ".detail-title h1",
    ".title-detail-wrapper h1",
)
SUMMARY_SELECTORS = (
    "h2.content-detail-sapo", "div.content-detail-sapo", "p.description", "div.lead", ".sapo", ".article-sapo",
    ".detail-sapo", ".detail-lead", "h2.sapo", ".summary", ".article-summary",
)
TIME_SELECTORS = (
    "span.content-detail-time", "span.date", "div.bread-crumb-detail__time", ".time", ".time-update",
    ".detail-time", ".article-time", ".publish-time",
)
BODY_SELECTORS = (
    "div.content-detail__content p", "article.fck_detail p:not(.author)", ".maincontent p", ".detail-content p",
    ".vnn-content p", ".article-body p", ".article-content p", ".content p",
)
# strict pairs: (summary element, content element), and the form inside a scope
STRICT_PAIR = ("h2.detail__summary", "div.detail__content")
STRICT_NESTED = ("div.noidung h2.sapo", "div.noidung div.ta-justify")
# listing regions of two of the sites
REGION_FEATURED = ("div", "zone zone--featured")
REGION_TIMELINE = ("div", "list_news timeline")
LINK_SUFFIX = ".htm"
MIN_TITLE_CHARS = 10
MIN_BODY_WORDS = 30
# ---------------------------------------------------------------------------

BASE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
LINKED_PAGES = 5_000_000  # X16: links whose keys are sent to all tasks, at most (about 500 MB)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# selectors over the element column
# ---------------------------------------------------------------------------
def marks(step: str) -> tuple[list[str], list[str]]:
    """The marks that ``h1.title``, ``.a.b``, ``a[name="value"]`` or ``p:not(.author)`` asks for, and those it refuses."""
    wanted: list[str] = []
    step, *refused = step.split(":not(")
    if "[" in step:
        step, _, attribute = step.partition("[")
        wanted.append(attribute.rstrip("]"))
    tag, *classes = step.split(".")
    return [*([tag] if tag else []), *(f".{c}" for c in classes), *wanted], [x.rstrip(")") for x in refused]


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, though ``use`` reads it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def having(tree: Column, wanted: list[str], refused=()) -> Column:
    """The elements that have all wanted marks and no refused one, in document order."""
    on_page = F.lit(True)
    for m in wanted:
        on_page = on_page & F.array_contains(tree["names"], m)

    def fits(e: Column) -> Column:
        out = F.lit(True)
        for m in wanted:
            out = out & F.array_contains(e["marks"], m)
        for m in refused:
            out = out & ~F.array_contains(e["marks"], m)
        return out

    return F.when(on_page, F.filter(tree["elements"], fits)).otherwise(F.slice(tree["elements"], 1, 0))


def inside(e: Column, outer: Column) -> Column:
    return (e["number"] > outer["number"]) & (e["number"] <= outer["last"])


def child_of(e: Column, outer: Column) -> Column:
    return e["parent"] == outer["number"]


def select(tree, selector: str) -> Column:
    """The elements that a selector (descendants ``a b``, children ``a > b``) matches, in document order."""
    tree, steps, child = _c(tree), selector.split(), False
    found = having(tree, *marks(steps[0]))
    for step in steps[1:]:
        if step == ">":
            child = True
            continue
        found, child = _under(found, having(tree, *marks(step)), child_of if child else inside), False
    return found


def _under(outer: Column, inner: Column, relation) -> Column:
    """The ``inner`` elements that stand in a relation to any of the ``outer`` ones."""
    def under(scope: Column) -> Column:
        return F.when(F.size(scope) > 0, F.filter(inner, lambda e: F.exists(scope, lambda s: relation(e, s)))).otherwise(F.slice(scope, 1, 0))

    return let(outer, under)


def region_step(tag: str | None, cls: str | None) -> str:
    """The selector step of a tag and its classes."""
    return (tag or "") + "".join(f".{c}" for c in (cls or "").split())


def regions(html, tag: str | None, cls: str | None = None) -> Column:
    """Inner HTML of every outermost element with this tag and class, in order."""
    h = F.coalesce(_c(html), F.lit(""))
    found = having(page_tree(h), *marks(region_step(tag, cls)))
    outermost = let(found, lambda scope: F.filter(scope, lambda e: ~F.exists(scope, lambda s: inside(e, s))))
    return F.transform(outermost, lambda e: F.substring(h, e["source_from"] + 1, e["source_to"] - e["source_from"]))


def text_of(tree: Column, e: Column) -> Column:
    """All text of an element, with its white space."""
    return F.substring(tree["text"], e["text_from"] + 1, e["text_to"] - e["text_from"])


def select_text(tree, selector: str) -> Column:
    """Text of the first element that a selector matches, null if none, with its white space."""
    tree = _c(tree)
    return F.get(F.transform(F.slice(select(tree, selector), 1, 1), lambda e: text_of(tree, e)), F.lit(0))


def first_text(tree, selectors) -> Column:
    """Stripped text of the first element of the first selector that matches; null if none does."""
    return F.coalesce(*[T.py_strip(select_text(tree, s)) for s in selectors])


def links_in(tree, region_tag: str = "nav", region_class: str | None = None, every: bool = False) -> Column:
    """``href`` of every ``<a>`` that has one inside the first listing region, or inside any of them."""
    tree = _c(tree)
    found = having(tree, *marks(region_step(region_tag, region_class)))
    anchors = F.filter(having(tree, ["a"]), lambda e: e["href"].isNotNull())
    return F.transform(_under(found if every else F.slice(found, 1, 1), anchors, inside), lambda e: e["href"])


def page_base(url) -> Column:
    """``scheme://host[:port]`` of a page URL."""
    return F.regexp_extract(_c(url), BASE, 1)


def absolutize(href, base) -> Column:
    """``http...`` kept; ``/x`` -> base + href; anything else -> base + '/' + href."""
    h, b = _c(href), _c(base)
    return (
        F.when(h.startswith("http"), h)
        .when(h.startswith("/"), F.concat(b, h))
        .otherwise(F.concat(b, F.lit("/"), h))
    )


def page_source(url) -> Column:
    """Site of a page: host without a leading ``www.``."""
    host = F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def page_category(url) -> Column:
    """Category of a page: first path segment ('' when none)."""
    return F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)", 1)


# ---------------------------------------------------------------------------
# links
# ---------------------------------------------------------------------------
def extract_links(pages: DataFrame, region_tag: str = "nav", region_class: str | None = None, every: bool = False) -> DataFrame:
    """Every ``<a href>`` inside the first listing region (or ``every`` one) -> ``page_id, url, pos, href``."""
    return explode_computed(with_tree(pages), links_in("_tree", region_tag, region_class, every), ["page_id", "url"], "pos", "href")


def filter_link_suffix(links: DataFrame, suffix: str = LINK_SUFFIX, col: str = "href") -> DataFrame:
    """X3."""
    return links.filter(F.endswith(F.col(col), F.lit(suffix)))


def absolutize_links(links: DataFrame) -> DataFrame:
    """``link`` = absolute form of ``href`` against the page's scheme and host."""
    return links.withColumn("link", absolutize("href", page_base("url")))


def distinct_links_per_page(pages: DataFrame, region_tag: str = "nav", region_class: str | None = None) -> DataFrame:
    """Distinct hrefs per page (``array_distinct`` before explode, no shuffle)."""
    links = F.array_distinct(links_in("_tree", region_tag, region_class))
    return explode_computed(with_tree(pages), links, ["page_id"], None, "href")


def dedupe_links_first(links: DataFrame, url_col: str = "link") -> DataFrame:
    """Corpus-wide URL dedupe; the first sighting (lowest ``page_id, pos``)
    wins and keeps its ``source``/``category``.

    ``min_by`` is partially aggregated map-side, so a URL present on a third
    of all pages (a nav link) costs one partial row per task.
    """
    tagged = links.select(
        F.col(url_col).alias("url"),
        F.struct(F.col("page_id"), F.col("pos")).alias("_seq"),
        F.struct(F.col("source"), F.col("category")).alias("_attrs"),
    )
    return tagged.groupBy("url").agg(F.min_by("_attrs", "_seq").alias("_a")).select(
        "url", F.col("_a.source").alias("source"), F.col("_a.category").alias("category")
    )


def page_links(pages: DataFrame, region_tag: str = "nav", region_class: str | None = None,
               suffix: str | None = None) -> DataFrame:
    """X1 -> X3 -> X4 -> X5 -> X7: ``page_id, pos, link, source, category``."""
    l = extract_links(pages, region_tag, region_class)
    if suffix is not None:
        l = filter_link_suffix(l, suffix)
    l = absolutize_links(l)
    # Repeats within a page (X5) are absorbed by the corpus-wide dedupe (X6),
    # which keeps the lowest (page_id, pos) anyway.
    return l.select("page_id", "pos", "link", page_source("url").alias("source"), page_category("url").alias("category"))


# ---------------------------------------------------------------------------
# Card links
# ---------------------------------------------------------------------------
def card_links(tree, cards=CARD_SELECTORS, links=CARD_LINK_SELECTORS) -> Column:
    """One link per card, over all card selectors; in a card the first link selector whose first anchor there has an href."""
    tree = _c(tree)
    sets = F.struct(*[select(tree, x).alias(f"s{i}") for i, x in enumerate(links)])

    def href(found: Column, card: Column) -> Column:
        first = F.slice(F.filter(found, lambda e: inside(e, card)), 1, 1)
        return F.get(F.transform(first, lambda e: e["href"]), F.lit(0))

    found = F.flatten(F.array(*[select(tree, c) for c in cards]))
    of_cards = F.when(F.size(found) > 0, let(sets, lambda s: F.transform(found, lambda card: F.coalesce(*[href(s[f"s{i}"], card) for i in range(len(links))]))))
    return F.array_distinct(F.filter(F.coalesce(of_cards, F.array().cast("array<string>")), lambda h: h.isNotNull()))


def extract_card_links(pages: DataFrame, cards=CARD_SELECTORS, links=CARD_LINK_SELECTORS) -> DataFrame:
    """X2 as rows ``page_id, url, pos, href``."""
    return explode_computed(with_tree(pages), card_links("_tree", cards, links), ["page_id", "url"], "pos", "href")


# ---------------------------------------------------------------------------
# Article fields
# ---------------------------------------------------------------------------
def title_text(tree, selectors=TITLE_SELECTORS) -> Column:
    """The first title that the selectors match; null if none."""
    return first_text(tree, selectors)


def summary_text(tree, selectors=SUMMARY_SELECTORS) -> Column:
    """The first summary that the selectors match, else ''."""
    return F.coalesce(first_text(tree, selectors), F.lit(""))


def time_text(tree, selectors=TIME_SELECTORS) -> Column:
    """The first publish time that the selectors match, else ''."""
    return F.coalesce(first_text(tree, selectors), F.lit(""))


def body_text(tree, selectors=BODY_SELECTORS) -> Column:
    """X11: the paragraphs of the first selector that has any, stripped, empty ones left out, joined with newlines; else ''."""
    tree = _c(tree)

    def joined(found: Column) -> Column:
        texts = F.filter(F.transform(found, lambda e: T.py_strip(text_of(tree, e))), lambda x: x != "")
        return F.when(F.size(found) > 0, F.array_join(texts, "\n"))

    return F.coalesce(*[let(select(tree, s), joined) for s in selectors], F.lit(""))


def with_tree(pages: DataFrame) -> DataFrame:
    """Adds ``_tree``, the page's elements: all that the fields read."""
    return pages.withColumn("_tree", page_tree("html"))


def extract_field(pages: DataFrame, field, name: str, selectors=None) -> DataFrame:
    """``page_id`` and one text field (:func:`title_text`, :func:`summary_text`, :func:`time_text` or :func:`body_text`)."""
    value = field("_tree", selectors) if selectors is not None else field("_tree")
    return with_tree(pages).select("page_id", value.alias(name))


def extract_strict(pages: DataFrame, pair=STRICT_PAIR, strip: bool = False) -> DataFrame:
    """Both elements required, else the page is dropped; X13 is the same
    with selectors inside a scope (``STRICT_NESTED``) and stripped text."""
    summary, content = (select_text("_tree", p) for p in pair)
    if strip:
        summary, content = T.py_strip(summary), T.py_strip(content)
    f = with_tree(pages).select("page_id", "url", summary.alias("summary"), content.alias("content"))
    return filter_computed(f, F.col("summary").isNotNull() & F.col("content").isNotNull())


def gate(title: Column, body: Column) -> Column:
    """Title present, >= 10 characters, body >= 30 words."""
    return title.isNotNull() & (F.char_length(title) >= MIN_TITLE_CHARS) & (T.word_count(body) >= MIN_BODY_WORDS)


ARTICLE = ("page_id", "title", "summary", "content", "pub_date", "category", "url", "source", "scraped_at")


class Fields:
    """The selector lists of a site, by field."""

    def __init__(self, title=TITLE_SELECTORS, summary=SUMMARY_SELECTORS, pub_date=TIME_SELECTORS, content=BODY_SELECTORS):
        self.title, self.summary, self.pub_date, self.content = title, summary, pub_date, content


def gate_pages(pages: DataFrame, fields: Fields | None = None) -> DataFrame:
    """``page_id, url, title, content`` of the pages that pass the gate."""
    f = fields or Fields()
    p = with_tree(pages).select("page_id", "url", title_text("_tree", f.title).alias("title"), body_text("_tree", f.content).alias("content"))
    return filter_computed(p, gate(F.col("title"), F.col("content")))


def pages_to_articles(pages: DataFrame, scraped_at: str = "1970-01-01 07:00:00", fields: Fields | None = None) -> DataFrame:
    """Gated pages -> raw wide articles
    ``page_id, title, summary, content, pub_date, category, url, source, scraped_at``.

    A page that was reached by a link (X16) has the link's ``source`` and
    ``category`` as columns, which go into the article; else they come from
    the page's own URL.  ``scraped_at`` is an argument so reruns are
    reproducible.
    """
    f = fields or Fields()
    linked = {"source", "category"} <= set(pages.columns)
    p = with_tree(pages).select(
        "page_id",
        title_text("_tree", f.title).alias("title"),
        summary_text("_tree", f.summary).alias("summary"),
        body_text("_tree", f.content).alias("content"),
        time_text("_tree", f.pub_date).alias("pub_date"),
        (F.col("category") if linked else page_category("url")).alias("category"),
        "url",
        (F.col("source") if linked else page_source("url")).alias("source"),
        F.lit(scraped_at).alias("scraped_at"),
    )
    return filter_computed(p, gate(F.col("title"), F.col("content")))


# ---------------------------------------------------------------------------
# Links -> fetched pages -> articles
# ---------------------------------------------------------------------------
def join_links_pages(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Each unique link is looked up among the fetched pages (equi inner
    join on url); the link's ``source`` and ``category`` go with the page.

    Both sides grow with the crawl, so no broadcast hint: AQE picks a
    broadcast only when the runtime size of a side is under its threshold.
    """
    return pages.drop("source", "category").join(links.select("url", "source", "category"), "url", "inner")


def links_to_articles(listing: DataFrame, fetched: DataFrame, fields: Fields | None = None, region_tag: str = "nav",
                      region_class: str | None = None, suffix: str | None = None, linked_pages: int = LINKED_PAGES) -> DataFrame:
    """X1 -> X3 -> X4 -> X6 -> X16 -> X15: the links of listing pages, each once
    and by its first sighting, looked up among the fetched pages and extracted.

    Pages are extracted where they lie and only the articles meet the links, so no
    HTML is shuffled.  Up to ``linked_pages`` links, their URLs first go to all
    tasks, and pages that no link leads to are not extracted at all.
    """
    links = materialize(dedupe_links_first(page_links(listing, region_tag, region_class, suffix)), "links")
    return articles_of(links, fetched, fields, linked_pages)


def articles_of(links: DataFrame, fetched: DataFrame, fields: Fields | None = None, linked_pages: int = LINKED_PAGES) -> DataFrame:
    """X16 -> X15 for distinct ``links`` (``url, source, category``), a written table."""
    if links.count() <= linked_pages:
        fetched = fetched.join(F.broadcast(links.select("url")), "url", "left_semi")
    return join_links_pages(links, pages_to_articles(fetched, fields=fields)).select(*ARTICLE)
