"""Operators on pages, conversations and embeddings: awkward cases, round trips, brute force."""

import hashlib
import html as entities
import os
import re
import time

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusforge.llm import chat, encode, vectors, warc
from corpusforge.llm.html import Page, main_text

SF = "/root/testdata/sf0.01"
PAGE_SCHEMA = "page_id bigint, url string, html string, host string, path string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "p", "d") for r in rows], PAGE_SCHEMA)


# --- 3: HTML ----------------------------------------------------------------

def by_tags(source):
    """The article of the test pages by plain patterns: they all have an article element of h1, p and br."""
    blocks = re.split(r"</?(?:p|h1|br)>", re.search(r"<article>(.*?)</article>", source, re.S)[1])
    texts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_main_text_of_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: by_tags(r.html) for r in table.collect()}
    rows = main_text(table).collect()
    assert len(rows) == len(want)
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in rows)


SHELL = ('<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header><a href="/">Home</a></header><nav><ul><li>menu</ul></nav>'
         '<div id="cookie-notice">cookies</div><div class="wrap">%s<div class="sidebar"><p>side</p></div></div><div class="ad-12">buy</div><footer>foot</footer></body></html>')


@pytest.mark.parametrize("inner,want", [
    ("<article><header><h1>T &amp; U</h1></header><p>One <b>two</b>\n three<p>four&nbsp;five</article>", "T & U\nOne two three\nfour five"),
    ("<div class='post-7 content'><p>&eacute;t&#233; &lt;b&gt;<br>new<ul><li>a<li>b</ul><form><input>go</form><div class=comments><p>c</div></div>", "été <b>\nnew\na\nb"),
    ("<main><aside>x</aside><p>kept<script>var a='</p>';</script> on</p><!-- <p>no</p> --></main>", "kept on"),
    ("<main><table><tr><td>a<td>b</table><pre>x\n  y</pre><noscript>n</noscript></main>", "a\nb\nx y"),
])
def test_article_parts(inner, want):
    p = Page(SHELL % inner)
    assert p.text(p.best()) == want


@pytest.mark.parametrize("source", ["", "<", "<p", "<p a='", "</p></p>", "<div><b>x</div> y</b>", "<script>", "<!--", "&", "<a b=\"" * 50, "<div>" * 3000 + "x"])
def test_broken_pages(source):
    p = Page(source)
    p.text(p.best())


@pytest.mark.parametrize("inner,want", [
    ("<article><p>first half</p></article><article><p>other half</p></article>", "first half\nother half"),
    ("<main><article><p>first half</p></article><article><p>other half</p></article></main>", "first half\nother half"),
    ("<div class='article-text a1'><p>first half</p></div><div class='advert'><p>buy this now</p></div><div class='article-text a2'><p>other half</p></div>", "first half\nother half"),
    ("<article><p>teaser</p></article><div><p>the text of the whole page</p></div>", "the text of the whole page"),
    ("<article><p>one half here</p></article><div><p>unnamed half</p></div>", "one half here\nunnamed half"),
])
def test_split_articles_stay_whole(spark, inner, want):
    page = SHELL % inner
    p = Page(page)
    assert p.text(p.best()) == want
    assert main_text(pages(spark, [(1, "http://a/", page)])).collect()[0].text == want


PROSE = "A long paragraph of running text that belongs to the article and goes on well beyond one line of it."


@pytest.mark.parametrize("inner,want", [
    (f"<section id=discussion><h2 id=navigation>Navigation</h2><p>{PROSE}</p></section>", f"Navigation\n{PROSE}"),
    ("<h2 id='social-impact' class='section-header'>Impact</h2><p>a <span class='hljs-comment'># note</span> b</p>", "Impact\na # note b"),
    ("<table class='side-by-side'><tr><td class='side'>x<td>y</table>", "x\ny"),
    ("<p>before <svg class=i /> after</p><p>end</p>", "before after\nend"),
    (f"<p>kept</p><div class='related'><p><a href=x>{PROSE}</a></p></div><div class='comments'><p>short</p></div>", "kept"),
    (f"<p>kept</p><div class='promo entry-text'><p>{PROSE}</p></div>", f"kept\n{PROSE}"),
])
def test_article_parts_named_like_others_stay(inner, want):
    for article in ("<article>%s</article>", "<div class='post'>%s</div>"):
        p = Page(SHELL % (article % inner))
        assert p.text(p.best()) == want


NAMED_PROSE = "A reader wrote this long remark, which reads like any paragraph of running text and goes on for more than a line of it."


@pytest.mark.parametrize("part", [
    f"<section class='comments'><p>{NAMED_PROSE}</p></section>", f"<div id='comments'><p>{NAMED_PROSE}</p></div>", f"<div class='cookie-notice'><p>{NAMED_PROSE}</p></div>",
    f"<div class='advert sponsored'><p>{NAMED_PROSE}</p></div>", f"<div class='post-comments'><p>{NAMED_PROSE}</p></div>", f"<div class='sidebar-content'><p>{NAMED_PROSE}</p></div>",
    f"<p class='advert'>{NAMED_PROSE}</p>", f"<figure class='ad'><p>{NAMED_PROSE}</p></figure>", f"<ol class='comment-list'><li><article class='comment'><p>{NAMED_PROSE}</p></article></ol>",
    f"<div class='newsletterSignup entry'><p>{NAMED_PROSE}</p></div>", f"<article class='comment'><p>{NAMED_PROSE}</p></article>", f"<span class='share'>{NAMED_PROSE}</span>",
    f"<div role=dialog class=text><p>{NAMED_PROSE}</p></div>"])
def test_comments_notices_and_adverts_go(part):
    text = f"<p>{PROSE}</p>"
    for page in (f"<article>{text}{part}{text}</article>", f"<main>{text}{part}{text}</main>", f"<div class='post content'>{text}{text}</div>{part}", f"<article>{text}{text}</article>{part}"):
        p = Page(SHELL % page)
        assert p.text(p.best()) == f"{PROSE}\n{PROSE}"


@pytest.mark.parametrize("page,want", [
    ("<div class='layout-sidebar'><h1>T</h1><article><p>x y</p></article></div>", "x y"),
    ("<div class='content has-sidebar no-comments'><p>x y</p></div>", "x y"), ("<div class='ads-wrap'><article><p>x y</p></article></div>", "x y"),
    ("<article class='post comments-open tag-cookies'><p>x y</p></article>", "x y"), ("<div class='post category-newsletter'><p>x y</p></div>", "x y"),
    ("<article><pre><code><span class='token comment'># x</span> y</code></pre></article>", "# x y"), ("<article><p data-id='comments' aria-role=menu>x y</p></article>", "x y"),
])
def test_names_that_tell_about_something_else(page, want):
    p = Page(f"<html><body>{page}</body></html>")
    assert p.text(p.best()) == want


@pytest.mark.parametrize("source", ["<b>" * 80_000 + "</i>" * 80_000, "<!" * 250_000, "<div>" * 100_000 + "x", "<a href=x>t" * 50_000, "<button>" * 60_000 + "<p>" * 60_000,
                                    "<article>" + "<div class=related><p>x</p>" * 20_000, "<a " + '"' * 500_000, "<span>" * 80_000 + "</a>", "<!--" * 125_000])
def test_odd_pages_take_time_by_their_length(source):
    start = time.process_time()
    p = Page(source)
    p.text(p.at(p.path(p.best()[0])))
    assert time.process_time() - start < 5


def test_host_consensus(spark):
    """A page whose own best container is an advert-like box is read at its host's usual place."""
    usual = "<body><div class='x1'><p>%s</p></div><div class='y2'><p>%s</p></div></body>"
    rows = [(i, "http://h.example/a", usual % ("long text of the page " * 9, "short")) for i in range(5)]
    rows += [(9, "http://h.example/b", usual % ("brief text", "a very long box beside it " * 9)), (10, "http://other.example/", usual % ("brief text", "long box " * 20))]
    got = {r.page_id: r.text for r in main_text(pages(spark, rows)).collect()}
    assert got[9] == "brief text" and got[10].startswith("long box")


def test_page_cases(spark):
    rows = [(1, None, None), (2, "not a url", ""), (None, "http://a/", "<p>x</p>"), (3, "http://a/", "<p>x</p>"), (3, "http://a/", "<p>x</p>")]
    got = main_text(pages(spark, rows)).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.text, r.n_chars) for r in got) == [(False, 1, "", 0), (False, 2, "", 0), (False, 3, "x", 1), (False, 3, "x", 1), (True, 0, "x", 1)]
    assert main_text(pages(spark, [])).count() == 0


# --- 10: WARC ---------------------------------------------------------------

def test_archive_cases(spark):
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "http://c/ü", None), (4, "http://d/", ""), (5, "u", "é" * 1000), (None, "u", "same"),
            (1, "again", "same")]
    got = {}
    for r in warc.archive_table(pages(spark, rows)).collect():
        got.setdefault(r.page_id, []).append(r)
    assert all(r.error is None for v in got.values() for r in v)
    assert [r.record_type for r in got[1]] == ["response"] * 2 and got[2][0].refers_to == 1 and got[None][0].refers_to == 1
    assert got[3][0].record_type == "response" and got[4][0].refers_to == 3 and got[4][0].payload_bytes == 0
    assert got[5][0].payload_bytes == 2000 and got[2][0].payload_bytes == 4
    assert got[2][0].payload_digest == got[1][0].payload_digest == warc.base32_sha1(b"same")
    assert warc.archive_table(pages(spark, [])).count() == 0


def test_payloads_come_back(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    rows = warc.read_archives(spark, warc.write_archives(table)).collect()
    want = {r.page_id: r for r in table.collect()}
    assert len(rows) == len(want)
    for r in rows:
        assert r.error is None and r.url == want[r.page_id].url
        assert r.record_type == "revisit" or bytes(r.payload).decode() == want[r.page_id].html


def test_dictionary_leads_the_archive_and_frames_are_single():
    records = [warc.record(i, f"http://x/{i}", f"<html><body>page {i} {'text ' * (i % 7)}</body></html>".encode() * 9, warc.base32_sha1(b""), None) for i in range(300)]
    content = warc.archive(records)
    assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_MAGIC
    assert list(warc.frames(content)) == records
    raw = content[8:8 + int.from_bytes(content[4:8], "little")]
    packed = zstandard.compress(raw)
    assert list(warc.frames(content[:4] + len(packed).to_bytes(4, "little") + packed + content[8 + len(raw):])) == records
    assert list(warc.frames(content[:-3])) == [*records[:-1], None]  # cut off
    sizes = [len(x) for x in (content, warc.archive(records[:1]))]
    first = 8 + int.from_bytes(content[4:8], "little")
    broken = bytearray(content)
    broken[first + 40] ^= 0xFF
    assert list(warc.frames(bytes(broken))) == [None, *records[1:]] and sizes
    assert list(warc.frames(content[:first] + b"no frame at all" + content[first:])) == [None, *records]
    assert list(warc.frames(b"junk")) == [None] and list(warc.frames(b"")) == []


def test_damaged_archives_give_error_rows(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    root = warc.write_archives(table).removeprefix("file:")
    for name in sorted(x for x in os.listdir(root) if x.endswith(".warc.zst")):
        with open(f"{root}/{name}", "r+b") as f:
            content = f.read()
            f.seek(0)
            f.write(content[:-40])
            f.truncate()
    rows = warc.read_archives(spark, root).collect()
    assert {r.error for r in rows} == {None, "frame"} and sum(r.error is None for r in rows) > 200


@pytest.mark.parametrize("change,error", [
    (lambda r: b"X" + r, "version"), (lambda r: r.replace(b"WARC-Date", b"WARC-Dote"), "required fields"), (lambda r: r[:-5] + r[-4:], "record length"),
    (lambda r: r[:-4], "record length"), (lambda r: r.replace(b"body", b"bodi"), "payload digest"), (lambda r: r.replace(b"-Type: response", b"-Type: metadata"), "type"),
    (lambda r: r.replace(b"WARC-Date", b"warc-date").replace(b"Content-Length", b"content-length"), None), (lambda r: r.replace(b"http://x", b"http://\xff"), "header encoding"),
    (lambda r: r.replace(b"Content-Length: ", b"Content-Length: 9" + b"9" * 30), "record length"), (lambda r: r.replace(b"X-Page-Id: 1", "X-Page-Id: ²".encode()), None),
    (lambda r: b"", "version"), (lambda r: r, None)])
def test_reader_checks(change, error):
    body = b"<body>x</body>"
    assert warc.parse(change(warc.record(1, "http://x", body, warc.base32_sha1(body), None)))[-1] == error


# --- 4: chat ----------------------------------------------------------------

MARKS = st.lists(st.sampled_from(["\\", "### ", "#", " ", "</turn>", "</turn", "<", ":", ": ", "a", "\n", "é", "Assistant"]), max_size=12).map("".join)


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(MARKS, MARKS), max_size=4))
def test_template_is_reversible(turns):
    formatted = "".join("".join(chat.render(r, t)) for r, t in turns)
    assert chat.turns_of(formatted) == turns


CHAT_SCHEMA = "conv_id bigint, turn bigint, role string, text string, tree string, first string, conv string"


def test_chat_cases(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "more"), (3, 0, "user", "hi"),
            (3, 1, "assistant", "no"), (4, 0, None, None), (4, 1, "assistant", None), (5, None, "assistant", "x"), (5, None, "assistant", "x"),
            (None, 0, "user", "null id"), (6, 1, "assistant", "second"), (6, 0, "sys:tem", "### first </turn>\\")]
    df = spark.createDataFrame([(*r, "t", "f", "c") for r in rows], CHAT_SCHEMA)
    got = {r.conv_id: r for r in chat.format_table(df).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, None, -7}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[2].turns_sha256 == sha("user\nhi\nassistant\nyes\nuser\nmore\n") and got[2].loss_chars == 3
    assert got[4].turns_sha256 == sha("\n\nassistant\n\n") and got[4].loss_chars == 0
    assert got[5].loss_sha256 == sha("xx") and got[5].n_turns == 2
    assert got[6].turns_sha256 == sha("sys:tem\n### first </turn>\\\nassistant\nsecond\n") and got[6].loss_sha256 == sha("second")
    assert chat.prefix_trees(df.limit(0)).count() == 0


@pytest.mark.parametrize("tree", [512, 2])
def test_prefix_trees(spark, tree):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    copies = turns.selectExpr("conv_id + 1000 AS conv_id", "turn", "role", "text").unionByName(
        turns.selectExpr("conv_id + 2000 AS conv_id", "turn", "role", "if(turn >= 2, concat(text, ' changed'), text) AS text"))
    rows = chat.prefix_trees(turns.unionByName(copies), tree=tree).collect()
    seen, path = set(), encode.vocabulary_path()
    for r in rows:
        texts, positions = set(), r.position_ids
        assert len(r.input_ids) == len(positions) == max(r.end)
        for k, parent in enumerate(r.parent):
            own = (parent, encode.decode(path, np.array(r.input_ids[r.start[k]:r.end[k]])))
            assert own not in texts and parent < k  # once each, parents first
            texts.add(own)
            way, at = [], k
            while at >= 0:
                way.append((r.start[at], r.end[at]))
                at = r.parent[at]
            want = [x for a, b in reversed(way) for x in range(a, b)]
            assert [x for a, b in chat.attention_intervals(r, k) for x in range(a, b)] == want
            assert [positions[x] for x in want] == list(range(len(want)))
        seen |= set(r.conv_id)
    convs = turns.select("conv_id").distinct().count()
    assert len(seen) == 3 * convs and (tree == 2 or len(rows) <= convs)


def emitted(turns, tree):
    rows = chat.prefix_trees(turns, tree=tree).collect()
    return rows, sum(len(r.input_ids) for r in rows)


def test_a_hot_first_turn_parts_at_the_next_one(spark):
    """600 conversations with one system prompt, pairs of which share two more turns, and 200 equal ones."""
    said = "concat('words of turn ', {}, ' that go on for a little while so that they weigh something')"
    base = spark.range(600).select(F.col("id").alias("conv_id"), F.explode(F.expr("sequence(0, 3)")).alias("turn")).withColumn("role", F.expr("if(turn % 2 = 0, 'user', 'assistant')"))
    base = base.withColumn("text", F.expr(f"CASE WHEN turn = 0 THEN 'one prompt for all' WHEN turn < 3 THEN {said.format('conv_id div 2 * 10 + turn')} ELSE {said.format('conv_id * 7919')} END"))
    equal = spark.range(600, 800).selectExpr("id AS conv_id", "explode(sequence(0, 1)) AS turn").selectExpr("conv_id", "turn", "'user' AS role", "if(turn = 0, 'one prompt for all', 'the same') AS text")
    turns = base.unionByName(equal)
    rows, n = emitted(turns, 64)
    at = {c: i for i, r in enumerate(rows) for c in r.conv_id}
    assert len(at) == 800 and 12 <= len(rows) <= 30 and max(len(r.conv_id) for r in rows) <= 160
    assert all(at[str(2 * k)] == at[str(2 * k + 1)] for k in range(300))  # pairs share a sequence
    assert len({at[str(c)] for c in range(600, 800)}) <= 5
    one, least = emitted(turns, 10_000)
    assert len(one) == 1 and n < 1.05 * least
    assert sorted(map(tuple, chat.read_back(chat.prefix_trees(turns, tree=64)).collect())) == sorted(map(tuple, chat.read_back(chat.prefix_trees(turns)).collect()))


# --- 5: embeddings ----------------------------------------------------------

def brute_links(rows):
    ok = [(i, np.array(e, float) / np.abs(e).max(), label) for i, e, label in rows
          if e is not None and label is not None and i is not None and None not in e and np.isfinite(np.array(e, float)).all() and np.any(e)]
    parent, links = {i: i for i, _, _ in rows}, dict.fromkeys((i for i, _, _ in rows), 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a, la) in enumerate(ok):
        for j, b, lb in ok[:k]:
            if la == lb and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                links[i], links[j] = links[i] + 1, links[j] + 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (links[i], root(i), root(i) == i) for i in parent}


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = vectors.hadamard(x) / 8
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(vectors.hadamard(y) / 8, x)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    x, y = vectors.buckets(a), vectors.buckets(0.93 * a + np.sqrt(1 - 0.93**2) * b)
    assert (x[..., None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.999


@pytest.mark.parametrize("block", [1000, 7])
def test_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(vectors.vector_links, "__defaults__", (block,))
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 32))
    rows = [(i, (centres[i % 6] + rng.normal(size=32) * rng.choice([0.0, 0.1, 0.3, 0.6])).tolist(), int(i % 6) if i % 11 else 0) for i in range(240)]
    nan = float("nan")
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, [nan] * 32, 1), (903, [None] + [1.0] * 31, 1), (904, centres[1].tolist(), None), (905, [], 1),
             (906, [1e200] * 3, 1), (907, [2e200] * 3, 1), (908, [float("inf")] * 3, 1), (909, centres[1].tolist()[:16], 1)]
    df = spark.createDataFrame([(*r, "k", "b", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, key string, bucket string, id int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.vector_classes(df).collect()}
    assert got == brute_links(rows) and got[907] == (1, 906, False)


def test_vector_cases(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert vectors.vector_classes(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [2.0, 4.0], 0), (None, [1.0, 2.0], 0)], schema)
    got = sorted(((r.vec_id or 0), r.n_links, r.kept) for r in vectors.vector_classes(same).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_copies_collapse_before_they_meet(spark, monkeypatch):
    """Copies count as partners, but one vector of each kind enters the buckets."""
    met, whole = [], vectors.vector_links
    monkeypatch.setattr(vectors, "vector_links", lambda rows: met.append(rows.count()) or whole(rows, 5))
    rng = np.random.default_rng(3)
    a, other = rng.normal(size=(2, 32))
    b = a + rng.normal(size=32) * 0.05
    kinds = [(a, 0)] * 30 + [(b, 0)] * 20 + [(a, 1)] * 3 + [(other, 0), (np.zeros(32), 0), (np.zeros(32), 0)]
    rows = [(100 - i, v.tolist(), label) for i, (v, label) in enumerate(kinds)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.vector_classes(df).collect()}
    assert got == brute_links(rows) and got[100] == (49, 51, False)
    assert met == [4]
