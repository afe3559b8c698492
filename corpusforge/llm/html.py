"""Operator 3, main text of web pages: consensus host paths.

Every page is parsed to score its containers; its best one votes, by its
generalised path of tags and classes (digits removed), for the layout of its
host.  Sibling containers at that path are taken together.  Spark counts the
votes.  Pages whose best container does not lie at their host's winning path
are extracted again, from the container there, or from their own where the page
has none there; the others' text stands.

Elements that are not article text by their tag, role or class (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments) count for
nothing and are left out, inside an article too.  Containers are judged by the
words of their class or id: a word such as comments, cookie or advert always
drops one (but a container around the page's h1 or main element), words that
article parts also have, such as discussion or related, only if its text does
not look like prose or it stands outside the article.  Paragraphs, figures, list
items and inline elements go if such a word is a whole class of theirs
(not inside code), headings never.  Votes are partial aggregates, so a host with a
third of all pages is a few rows.  Pages are never shuffled by host: those to
extract again are found among small rows and looked up by page_id, and their
list is broadcast only if its written size is small.

Defined results: a null or empty page has the empty text; a page without a
host votes for no one and is extracted by itself; ties go to the smaller path;
repeated rows give repeated results; extra columns are not read; an empty table
gives an empty table.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.operators.plan_utils import materialize

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/><]*)((?:[^><"']|"[^"<]*"|'[^'<]*')*|[^><]*)>""", re.S)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul").split())
CONTAINER = frozenset("article body div main section td".split())
DROPPED_TAGS = frozenset("head nav footer aside form button select option menu dialog fieldset object canvas audio video map".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in a class or id that tell what a container is, wherever it stands.
STRONG_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsors sponsored cookie cookies consent gdpr notice notices newsletter "
    "newsletters subscribe subscription signup sidebar sidebars nav navbar navigation menu share sharing breadcrumb breadcrumbs pagination pager comment "
    "comments disqus popup modal").split())
#: Words that an article's own parts may have as well.
DOUBTFUL_WORDS = frozenset(("promo promotion aside footer notification alert overlay login social reply replies discussion form search widget widgets "
                            "toolbar skip").split())
WEAK_WORDS = frozenset("header masthead banner related recommended recommendations side tags meta teaser".split())
TEXT_WORDS = frozenset("article content main post entry story body text".split())
#: A class that begins so tells about what is around or inside the element, or what an article is about.
ABOUT = frozenset("has with without no is category tag type status format".split())
#: Elements judged by the words; tables and their cells outside an article only.
NAMED_TAGS = frozenset("div section ul ol dl aside table td".split())
#: Elements judged by strong words that are a whole class; an article only by those that it can be one of many of.
WHOLE_TAGS = frozenset("p figure li span a article".split())
ARTICLE_WORDS = frozenset("ad advert comment comments".split())
PROSE_BLOCK = 80  # characters of a long block: prose has half of its text in those, and a quarter of it in links at most

SHARE = 0.75  # of its parent's text that a container must hold to be preferred
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEEP, DOUBT, DROP = range(3)


def _words(value: str) -> set[str]:
    """Words of the classes, but of those that tell about something else."""
    out: set[str] = set()
    for name in value.split():
        found = [w.lower() for w in WORD.findall(name)]
        if found and found[0] not in ABOUT:
            out.update(found)
    return out


class Page:
    """The elements of a page in order, and its blocks of text with the element each is in.

    One pass over the tokens and a few over the elements; nothing looks back
    over open elements, so a page of any shape takes time by its length.
    """

    def __init__(self, source: str):
        # by element number: parent, tag, tag with classes, last element inside, named like article text, verdict, and the nearest container above;
        # whether it lies in article or main, and in those or a container named like article text
        self.parent, self.tag, self.label, self.good, self.verdict, self.above = [-1], ["html"], ["html"], [False], [KEEP], [0]
        self.in_main, self.in_text = [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._parse(source)
        # what holds the page's main part is not dropped for its name; a page without other text may be one article so wrapped
        self.chars = self._drop({"main", "h1"}) or self._drop({"main", "h1", "article"}) or [0] * len(self.tag)
        self.blocks = [b for b in self.blocks if self.chars[b[0]]]

    # -- parsing ------------------------------------------------------------
    def _judge(self, tag: str, attributes: str, above: int, in_code: bool) -> tuple[str, bool, int]:
        """The element's classes without digits, whether it is named like article text, and what becomes of its text."""
        found: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(attributes) if attributes else ():
            found.setdefault(m[1].lower(), next((x for x in m.groups()[1:] if x is not None), ""))
        classes = found.get("class", "").replace(">", "")
        label = tag + "".join(sorted("." + re.sub(r"\d+", "", c) for c in classes.split()))
        if tag in DROPPED_TAGS or found.get("role", "").lower() in DROPPED_ROLES or (tag == "header" and not self.in_main[above]):
            return label, False, DROP
        if tag in WHOLE_TAGS:
            whole = set(classes.lower().split())
            strong = ARTICLE_WORDS if tag == "article" else STRONG_WORDS
            return label, tag == "article", KEEP if in_code or whole.isdisjoint(strong) else DROP
        names = _words(f"{classes} {found.get('id', '')}")
        good, inside = not TEXT_WORDS.isdisjoint(names), self.in_text[above]
        if tag not in NAMED_TAGS or (inside and tag in ("table", "td")):
            return label, good, KEEP
        if not STRONG_WORDS.isdisjoint(names):
            return label, good, DROP
        if not DOUBTFUL_WORDS.isdisjoint(names) or (not good and not WEAK_WORDS.isdisjoint(names)):
            return label, good, DOUBT if inside or good else DROP
        return label, good, KEEP

    def _open(self, tag: str, label: str, good: bool, verdict: int, above: int) -> int:
        self.parent.append(above)
        self.tag.append(tag)
        self.label.append(label)
        good &= tag in CONTAINER
        self.good.append(good)
        self.verdict.append(verdict)
        self.above.append(above if self.tag[above] in CONTAINER else self.above[above])
        self.in_main.append(self.in_main[above] or tag in ("article", "main"))
        self.in_text.append(self.in_text[above] or tag in ("article", "main") or (good and tag != "body"))
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        # open elements: tag, number of the innermost block, whether in a link, whether in code, whether text is dropped for sure
        stack: list[tuple[str, int, bool, bool, bool]] = [("html", 0, False, False, False)]
        places: dict[str, list[int]] = {}  # where on the stack a tag is open
        walls: list[int] = []  # and containers
        text: list[str] = []
        linked = at = 0
        end = len(source)
        last = source.rfind(">") + 1  # no tag ends behind it

        def flush(node: int) -> None:
            nonlocal linked
            if text:
                block = SPACE.sub(" ", "".join(text)).strip()
                if block:
                    self.blocks.append((node, block, linked))
                text.clear()
            linked = 0

        def cut(k: int) -> None:
            while len(stack) > k:
                tag = stack.pop()[0]
                places[tag].pop()
                if tag in CONTAINER:
                    walls.pop()

        while at < end:
            m = TOKEN.search(source, at, last) if at < last else None
            stop = m.start() if m else end
            _, node, in_link, in_code, off = stack[-1]
            if stop > at and not off:
                text.append(entities.unescape(source[at:stop]))
                if in_link:
                    linked += len(SPACE.sub(" ", text[-1]).strip())
            if not m:
                break
            at, tag = m.end(), (m[2] or "").lower()
            if m[1]:
                k = places[tag][-1] if places.get(tag) else 0
                # small elements are not sought outside their container
                if k and (tag in BLOCK and tag not in ("p", "li") or not walls or k >= walls[-1]):
                    if stack[k - 1][1] != node:
                        flush(node)
                    cut(k)
            elif tag in ("svg", "math") and m[3].endswith("/"):
                continue
            elif tag in RAW:
                close = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = close.end() if close else end
            elif tag in ("br", "hr"):
                flush(node)
            elif not tag or tag in VOID or tag == "html":
                continue
            elif tag in BLOCK:
                flush(node)
                self._imply(stack, tag, cut)
                _, above, in_link, in_code, off = stack[-1]
                label, good, verdict = self._judge(tag, m[3], above, in_code)
                places.setdefault(tag, []).append(len(stack))
                if tag in CONTAINER:
                    walls.append(len(stack))
                # what holds the page's heading or main part is decided at the end
                sure = off or (verdict == DROP and (tag in DROPPED_TAGS or tag not in CONTAINER))
                stack.append((tag, self._open(tag, label, good, verdict, above), in_link, in_code or tag == "pre", sure))
            elif tag in ("a", "code", "span") or tag in DROPPED_TAGS or "role" in m[3]:
                # other inline elements change nothing for their text
                if tag == "a" and in_link and places.get("a") and (not walls or places["a"][-1] >= walls[-1]):
                    cut(places["a"][-1])
                    _, node, in_link, in_code, off = stack[-1]
                verdict = self._judge(tag, m[3], node, in_code)[2]
                if tag != "span" or verdict == DROP:
                    places.setdefault(tag, []).append(len(stack))
                    stack.append((tag, node, in_link or tag == "a", in_code or tag == "code", off or verdict == DROP))
                else:
                    places.setdefault(tag, []).append(len(stack))
                    stack.append((tag, node, in_link, in_code, off))
        flush(stack[-1][1])

    @staticmethod
    def _imply(stack: list, tag: str, cut) -> None:
        """A block ends an open paragraph, and some end one of their own kind."""
        ends = CLOSES.get(tag, frozenset()) | {"p"} | ({"head"} if tag == "body" else set())
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in ends:
                cut(k)
                return
            if stack[k][0] in BLOCK:
                return

    def _drop(self, heads: set[str]) -> list[int]:
        """Characters by element, without dropped ones, and doubtful ones whose text does not look like prose (inner ones first); empty if none are left."""
        n = len(self.tag)
        chars, long, links = [0] * n, [0] * n, [0] * n
        head = [t in heads and v == KEEP for t, v in zip(self.tag, self.verdict, strict=True)]
        for node, text, linked in self.blocks:
            chars[node] += len(text)
            long[node] += len(text) if len(text) >= PROSE_BLOCK else 0
            links[node] += linked
        gone = [False] * n
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            head[up] |= head[k]
            if self.verdict[k] == DROP:
                gone[k] = not head[k] or self.tag[k] in DROPPED_TAGS
            elif self.verdict[k] == DOUBT:
                gone[k] = 2 * long[k] < chars[k] or 4 * links[k] > chars[k]
            if not gone[k]:
                chars[up] += chars[k]
                long[up] += long[k]
                links[up] += links[k]
        for k in range(1, n):
            gone[k] |= gone[self.parent[k]]
        return [0 if g else c for g, c in zip(gone, chars, strict=True)] if chars[0] else []

    # -- choosing -----------------------------------------------------------
    def best(self) -> list[int]:
        """The containers that hold the article, going down while one child, or siblings named like article text, hold most of the text."""
        children: dict[int, list[int]] = {}
        for k in range(1, len(self.tag)):
            if self.chars[k] and self.tag[k] in CONTAINER:
                children.setdefault(self.above[k], []).append(k)
        at = 0
        while True:
            weight = {k: self.chars[k] * self._rank(k) for k in children.get(at, ())}
            next_ = max(weight, key=lambda k: (weight[k], -k), default=None)
            if next_ is None or self.tag[at] == "article":
                return [at]
            if (self.tag[at] == "main" or self.good[at]) and self.tag[next_] not in ("article", "main"):
                return [at]
            if self.chars[next_] < SHARE * self.chars[at]:
                next_ = max(weight, key=lambda k: (self.chars[k], -k))
            if self.chars[next_] >= SHARE * self.chars[at]:
                at = next_
                continue
            # no child holds the text: those named like article text at one path may, together
            named: dict[tuple[int, str], list[int]] = {}
            for k in weight:
                if self._rank(k) > 1:
                    named.setdefault((self.parent[k], self.label[k]), []).append(k)
            held = max(named.values(), key=lambda ks: (sum(weight[k] for k in ks), -ks[0]), default=[])
            return held if sum(self.chars[k] for k in held) >= SHARE * self.chars[at] else [at]

    def _rank(self, node: int) -> int:
        return 4 if self.tag[node] in ("article", "main") else 2 if self.good[node] else 1

    def path(self, node: int) -> str:
        """The generalised path of an element, from the root."""
        out = []
        while node >= 0:
            out.append(self.label[node])
            node = self.parent[node]
        return ">".join(reversed(out))

    def text(self, nodes: list[int]) -> str:
        inside = [False] * len(self.tag)
        for k in nodes:
            inside[k] = True
        for k in range(1, len(inside)):
            inside[k] |= inside[self.parent[k]]
        return "\n".join(t for n, t, _ in self.blocks if inside[n])

    def at(self, path: str | None) -> list[int]:
        """All containers at a path, or the page's own best ones."""
        steps = path.split(">") if path else []
        depth = [0] * len(self.tag)  # steps of the path that lead to an element; 0 if it lies elsewhere
        for k, label in enumerate(self.label):
            up = depth[self.parent[k]] if k else 0
            if (up or not k) and up < len(steps) and steps[up] == label:
                depth[k] = up + 1
        there = [k for k, d in enumerate(depth) if d and d == len(steps) and self.chars[k]]
        return there or self.best()


def own_extract(page: Column) -> Column:
    """Struct of the generalised path of a page's best container (null without text) and the text there."""

    @F.arrow_udf("path string, text string")
    def run(pages: pa.Array) -> pa.Array:
        paths, texts = [], []
        for source in pages.to_pylist():
            p = Page(source or "")
            path = p.path(p.best()[0]) if p.blocks else None
            paths.append(path)
            texts.append(p.text(p.at(path)))
        return pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])

    return run(page)


def extract(page: Column, path: Column) -> Column:
    """The text of a page's container at ``path``, or of its own best container."""

    @F.arrow_udf("string")
    def run(pages: pa.Array, paths: pa.Array) -> pa.Array:
        out = []
        for source, path in zip(pages.to_pylist(), paths.to_pylist(), strict=True):
            p = Page(source or "")
            out.append(p.text(p.at(path)))
        return pa.array(out, pa.string())

    return run(page, path)


def host(url: Column) -> Column:
    """The host of a URL, lower case; null if it has none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winning_paths(votes: DataFrame) -> DataFrame:
    """``host, winner``: the path that most rows of each ``host`` voted for."""
    counts = votes.filter("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("n"))
    # the most votes, then the smaller path
    top = counts.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), "path")).alias("top"))
    return top.select("host", F.col("top.path").alias("winner"))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), host(pages[url]).alias("host"), pages[html].alias("html"))
    own = materialize(rows.select("page_id", "url", "host", own_extract(F.col("html")).alias("x")).select("page_id", "url", "host", "x.*"), "own-text")
    votes = own.select("page_id", "host", "path")
    # written, so that Spark can split a host with a third of all pages, or broadcast the winners if they are few
    winners = materialize(winning_paths(votes), "winners")
    away = votes.join(winners, "host").filter("NOT path <=> winner")
    away = materialize(away.select(F.col("page_id").alias("id"), F.col("host").alias("h"), "winner").distinct(), "away")
    there = lambda df: df["page_id"].eqNullSafe(away["id"]) & (df["host"] == away["h"])
    stands = own.join(away, there(own), "left_anti").select("page_id", "url", "text")
    again = rows.join(away, there(rows)).select("page_id", "url", extract(F.col("html"), F.col("winner")).alias("text"))
    return stands.unionByName(again).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
