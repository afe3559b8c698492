"""X1-X16 on hand-made pages with the sites' own classes."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from corpusforge.functions.elements import _Page, page_tree
from corpusforge.operators import html as X

PAGE = """<html><head><title>t</title><script>var x="</p><h1>no</h1>";</script><style>p{}</style></head>
<body><!-- <a href="/hidden">x</a> -->
<div class="zone zone--featured"><div><a href="/z1.htm">1</a></div><div class="x"><a href="/z2.htm">2</a></div></div>
<div class="list_news timeline"><a href="/t1.htm">1</a></div><div class="list_news timeline"><div><a href="/t2.htm">2</a></div></div>
<div class="box"><ul>
 <li class="item-news"><h3 class="title-news"><a href="/a-1.htm">One</a></h3><a href="/other">o</a></li>
 <li class="item-news"><a class="vnn-title" href="https://x.vn/b-2.htm">Two</a></li>
 <li class="item-news"><a>no href</a></li>
</ul></div>
<nav><a href="/n1.htm">n1</a><a href='rel.htm'>r</a><a href="/n1.htm">dup</a><a href="http://o.vn/n3">n3</a></nav>
<h1 class="content-detail-title">  Title of the article &amp; more  </h1>
<h2 class="content-detail-sapo">The sapo</h2>
<span class="date">01/02/2025</span>
<div class="content-detail__content"><p>First para &quot;q&quot;.</p><p class="author">Author</p>
<p>  </p><p>Second <b>bold</b> para<br><p>Third unclosed
</div>
<div class="noidung"><h2 class="sapo"> Nested sapo </h2><div class="ta-justify"><div>inner</div> body </div></div>
<h2 class="detail__summary"> S </h2><div class="detail__content"><div>a</div><div>b</div></div>
<article class="fck_detail"><p>Alpha beta gamma.<p class="author">me<p>Delta &amp; epsilon</p></article>
</body></html>"""


def _pages(spark):
    return spark.createDataFrame([(1, "https://www.site.vn/cat/page-1.htm", PAGE)], "page_id long, url string, html string")


def test_regex_links_absolute_and_dedupe(spark):
    p = _pages(spark)
    links = X.extract_links(p).orderBy("pos").collect()
    assert [r.href for r in links] == ["/n1.htm", "rel.htm", "/n1.htm", "http://o.vn/n3"]
    ab = [r.link for r in X.absolutize_links(X.extract_links(p)).orderBy("pos").collect()]
    assert ab == ["https://www.site.vn/n1.htm", "https://www.site.vn/rel.htm", "https://www.site.vn/n1.htm",
                  "http://o.vn/n3"]
    assert X.filter_link_suffix(X.extract_links(p)).count() == 3
    assert X.distinct_links_per_page(p).count() == 3
    d = {r.url: (r.source, r.category) for r in X.dedupe_links_first(X.page_links(p)).collect()}
    assert d["https://www.site.vn/n1.htm"] == ("site.vn", "cat") and len(d) == 3


def test_dedupe_first_seen_wins(spark):
    rows = [(2, 1, "u", "s2", "late"), (1, 5, "u", "s1", "early"), (1, 9, "v", "s1", "x")]
    df = spark.createDataFrame(rows, "page_id long, pos long, link string, source string, category string")
    got = {r.url: r.category for r in X.dedupe_links_first(df).collect()}
    assert got == {"u": "early", "v": "x"}


def test_regions_close_where_they_should(spark):
    p = _pages(spark)
    assert [r.href for r in X.extract_links(p, *X.REGION_FEATURED).orderBy("pos").collect()] == ["/z1.htm", "/z2.htm"]
    assert [r.href for r in X.extract_links(p, *X.REGION_TIMELINE, every=True).orderBy("pos").collect()] == ["/t1.htm", "/t2.htm"]
    assert [r.href for r in X.extract_links(p, *X.REGION_TIMELINE).collect()] == ["/t1.htm"]


@pytest.mark.parametrize("html,tag,cls,want", [
    ("<div class=a>1<div>2</div>3</div><div class='b a c'>4</div><div class=ab>5</div>", "div", "a", ["1<div>2</div>3", "4"]),
    ("<div><div class=a>in</div></div>", "div", "a", ["in"]),
    ("<div class=a>open <div>x</div>", "div", "a", ["open <div>x</div>"]),
    ("</div><DIV CLASS=\"a\">u</DIV>", "div", "a", ["u"]),
    ("<p class=a>p</p><span class=a>s</span><p>n</p>", None, "a", ["p", "s"]),
    ("<divx class=a>no</divx>", "div", "a", []),
    ("", "div", None, []),
])
def test_regions(spark, html, tag, cls, want):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(X.regions("h", tag, cls).alias("r")).first().r == want


def test_fields_by_selector_priority(spark):
    f = X.with_tree(_pages(spark)).select(
        X.title_text("_tree").alias("title"), X.summary_text("_tree").alias("summary"), X.time_text("_tree").alias("time"),
        X.body_text("_tree").alias("body"), X.body_text("_tree", X.BODY_SELECTORS[1:]).alias("fck"), X.card_links("_tree").alias("cards")).first()
    assert f.title == "Title of the article & more"
    assert f.summary == "The sapo"
    assert f.time == "01/02/2025"
    assert f.body == 'First para "q".\nAuthor\nSecond bold para\nThird unclosed'
    assert f.fck == "Alpha beta gamma.\nDelta & epsilon"  # without the author's paragraph
    assert f.cards == ["/a-1.htm", "https://x.vn/b-2.htm"]


def test_strict_pairs(spark):
    p = _pages(spark)
    assert [(r.summary, r.content) for r in X.extract_strict(p).collect()] == [(" S ", "ab")]
    assert [(r.summary, r.content) for r in X.extract_strict(p, X.STRICT_NESTED, strip=True).collect()] == [("Nested sapo", "inner body")]
    half = spark.createDataFrame([(1, "https://a.vn/x", "<div class='noidung'><h2 class='sapo'>s</h2></div>"), (2, "u", None)],
                                 "page_id long, url string, html string")
    assert X.extract_strict(half, X.STRICT_NESTED).count() == X.extract_strict(half).count() == 0


def test_gate_and_articles(spark):
    p = _pages(spark)
    assert X.gate_pages(p).count() == 0  # body under 30 words
    long = p.withColumn("html", F.regexp_replace("html", "First", "w " * 40))
    art = X.pages_to_articles(long)
    assert art.select("source", "category").first() == ("site.vn", "cat")
    assert art.select("title", "summary", "pub_date").first() == ("Title of the article & more", "The sapo", "01/02/2025")


def test_links_to_articles_carries_the_links_category(spark):
    p = _pages(spark)
    fetched = p.withColumns({"page_id": F.lit(9).cast("long"), "url": F.lit("https://www.site.vn/z2.htm"), "html": F.regexp_replace("html", "First", "w " * 40)})
    got = X.links_to_articles(p, fetched, None, *X.REGION_FEATURED, suffix=".htm").collect()
    assert [(r.page_id, r.url, r.source, r.category) for r in got] == [(9, "https://www.site.vn/z2.htm", "site.vn", "cat")]


def test_join_links_pages(spark):
    links = spark.createDataFrame([("https://a.vn/1", "a.vn", "c"), ("https://a.vn/2", "a.vn", "c")],
                                  "url string, source string, category string")
    pages = spark.createDataFrame([(7, "https://a.vn/2"), (8, "https://a.vn/9")], "page_id long, url string")
    got = X.join_links_pages(links, pages).collect()
    assert [(r.url, r.page_id, r.category) for r in got] == [("https://a.vn/2", 7, "c")]


def _tree(spark, *sources):
    return spark.createDataFrame([(i, x) for i, x in enumerate(sources)], "i int, html string").select("i", page_tree("html").alias("t")).orderBy("i")


@pytest.mark.parametrize("html,selector,want", [
    ("<div class=a>1<div class=b>2<p>3</p></div></div><p>4</p>", ".a p", ["3"]), ("<div class=a><b><p>3</p></b><p>4</p></div>", "div.a > p", ["4"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul > li", ["a", "bc", "c", "d"]), ("<p>a<p class=x>b</p>c<p class='y x'>d", "p:not(.x)", ["a"]),
    ("<a title='x > y' href=/r>t</a>", "a", ["t"]), ("<h1>5 < 6 and 7 > 3</h1>", "h1", ["5 < 6 and 7 > 3"]), ("<h1>a<!-- <h1>b</h1> -->c<script>'</h1>'</script>d</h1>", "h1", ["acd"]),
    ("<h1>Th&agrave;nh ph&#7889; &#x1F600; &copy2 &notit; &ltx &nosuch; &amp;lt;</h1>", "h1", ["Thành phố 😀 ©2 ¬it; <x &nosuch; &lt;"]),
    ("<div class='c&#97;t'>x</div>", ".cat", ["x"]), ("<div><b>x</div> y</b>", "b", ["x"]), ("</div></p><p>x", "p", ["x"]), ("<p>x</p><p class='", "p", ["x"]),
    ("<a data-medium=\"Item-1\" href=x>m</a><a data-medium=Item-2>n</a>", 'a[data-medium="Item-1"]', ["m"]), ("<DIV CLASS='A b'>u</DIV><div class=a>l</div>", "div.a", ["l"]),
    ("<p>a<div>b</div><p>c<table><tr><td>1<td>2<tr><td>3</table>", "td", ["1", "2", "3"]), ("x<br>y<img src='>'>z", "br", [""]), (None, "p", []), ("", "p", []), ("<div>" * 300 + "x", "div div.q", []),
])
def test_selectors(spark, html, selector, want):
    t = _tree(spark, html).select(F.transform(X.select("t", selector), lambda e: X.text_of(F.col("t"), e)).alias("x"))
    assert t.first().x == want


def test_attributes_are_read_as_such(spark):
    """Links are those of href, whatever stands before it."""
    page = """<nav><a data-href="/track" href="/real.htm">1</a><a title="x > y" href='/two.htm?a=1&amp;b=2'>2</a><a HREF=/three.htm>3</a><a name=href>4</a>
    <a href="/first.htm" href="/last.htm">5</a><a href="/&eacute;&#233;">6</a></nav><nav><a href="/other">7</a></nav>"""
    df = spark.createDataFrame([(1, "http://a.vn/", page)], "page_id long, url string, html string")
    assert [r.href for r in X.extract_links(df).orderBy("pos").collect()] == ["/real.htm", "/two.htm?a=1&b=2", "/three.htm", "/last.htm", "/éé"]


def test_page_tree_is_linear(spark):
    for source in ("<b>" * 80_000 + "</i>" * 80_000, "<!" * 200_000, "<a b=\"" * 60_000, "<p>" * 80_000, "<script>" * 50_000, "<!--" * 80_000, "<" * 300_000, "<a " + "'" * 200_000):
        start = time.process_time()
        _Page(source, ())
        assert time.process_time() - start < 5


def test_elements_nest(spark):
    """Ranges of numbers and of characters nest, and an element's text is that of its range."""
    table = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for r in table.select(page_tree("html").alias("t")).limit(30).collect():
        for e in r.t.elements:
            up = r.t.elements[e.parent] if e.parent >= 0 else None
            assert up is None or (up.number < e.number <= e.last <= up.last and up.text_from <= e.text_from <= e.text_to <= up.text_to)


def test_one_pass_per_page_and_no_html_moves(spark):
    table = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    plan = X.pages_to_articles(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    for pages in (5_000_000, 0):
        plan = X.links_to_articles(table, table, linked_pages=pages)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hash" in x and "html" in x]
        assert all("html" not in x for x in _below_exchange(plan))


def _below_exchange(plan):
    """What the nodes right below shuffles hand on."""
    lines = plan.splitlines()
    return [lines[k + 1].split("[")[-1] for k, x in enumerate(lines[:-1]) if "Exchange hashpartitioning" in x and "Project" in lines[k + 1]]


def test_links_to_articles_with_and_without_pruning(spark):
    p = _pages(spark).withColumn("html", F.regexp_replace("html", "First", "w " * 40))
    fetched = p.withColumn("url", F.lit("https://www.site.vn/z2.htm")).unionByName(p.withColumn("url", F.lit("https://www.site.vn/unlinked.htm")))
    got = [sorted(map(tuple, X.links_to_articles(p, fetched, None, *X.REGION_FEATURED, suffix=".htm", linked_pages=n).collect())) for n in (1, 100)]
    assert len(got[0]) == 1 and got[0] == got[1]
