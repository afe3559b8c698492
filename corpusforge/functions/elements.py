"""A page as a column of numbered elements.

One pass over a page's tokens gives its text and, for every element, the range
of numbers and of characters that it takes up, so "inside" is a comparison of
numbers and an element's text is a piece of the page's.  Selectors are then
Spark expressions over that column (:mod:`corpusforge.operators.html`).

Tolerated as browsers do: ``<`` before anything but a letter is text, ``>`` may
stand in a quoted attribute, stray end tags count for nothing, an element left open ends
with the one around it, a block ends an open ``<p>``, and list items and table cells end
their like.  Scripts, styles and comments are no text.  Character references are
decoded in text and attributes: numbers, and every name of HTML5, with ``;`` or, as far as
the names allow, without.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset(("script", "style"))
BLOCK = frozenset(("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
                   "header html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
ENDS_ITS_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th")}

#: Attributes that selectors may ask for, besides classes.
ATTRIBUTES = ("data-medium",)

ELEMENT = "number int, last int, parent int, marks array<string>, href string, text_from int, text_to int, source_from int, source_to int"
#: ``names``: all marks on the page.  An element's marks are its tag, ``.class`` for each class, and ``name="value"`` for :data:`ATTRIBUTES`.
TREE = f"text string, names array<string>, elements array<struct<{ELEMENT}>>"

_TAG = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_NAME = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_END = re.compile(r"[\s/]*>")


def _attributes(source: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a tag from behind its name, and the place behind its end (-1 if it has none)."""
    found: dict[str, str] = {}
    while not (end := _END.match(source, at)):
        m = _NAME.match(source, at)
        if not m:
            return found, -1
        at, value = m.end(), ""
        if m[2]:
            quote = source[at:at + 1]
            if quote and quote in "\"'":
                stop = source.find(quote, at + 1)
                if stop < 0:
                    return found, -1
                value, at = source[at + 1:stop], stop + 1
            else:
                value = _BARE.match(source, at)[0]
                at += len(value)
        found[m[1].lower()] = value
    return found, end.end()


class _Page:
    """Elements as columns in document order, and the text."""

    def __init__(self, source: str, attributes: tuple[str, ...]):
        self.last: list[int] = []
        self.parent: list[int] = []
        self.marks: list[list[str]] = []
        self.href: list[str | None] = []
        self.spans: list[list[int]] = []  # text_from, text_to, source_from, source_to
        self.source, self.attributes, self.pieces, self.size = source, attributes, [], 0
        self.open: list[tuple[str, int]] = []
        self.where: dict[str, list[int]] = {}  # places on the stack of open elements, by tag
        self.blocks: list[int] = []  # and of block elements
        self._parse()

    def _cut(self, k: int, source_to: int) -> None:
        """Closes the open elements from place ``k`` on."""
        while len(self.open) > k:
            tag, number = self.open.pop()
            self.where[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            self.last[number] = len(self.last) - 1
            self.spans[number][1], self.spans[number][3] = self.size, source_to

    def _start(self, tag: str, found: dict[str, str], begin: int, end: int) -> None:
        while tag in BLOCK and self.blocks and self.open[self.blocks[-1]][0] in ("p", *ENDS_ITS_LIKE.get(tag, ())):
            self._cut(self.blocks[-1], begin)
        number = len(self.last)
        self.last.append(number)
        self.parent.append(self.open[-1][1] if self.open else -1)
        classes = dict.fromkeys(f".{c}" for c in unescape(found.get("class", "")).split())
        self.marks.append([tag, *classes, *(f'{a}="{unescape(found[a])}"' for a in self.attributes if a in found)])
        self.href.append(unescape(found["href"]) if "href" in found else None)
        self.spans.append([self.size, self.size, end, end])
        if tag not in VOID:
            self.where.setdefault(tag, []).append(len(self.open))
            if tag in BLOCK:
                self.blocks.append(len(self.open))
            self.open.append((tag, number))

    def _say(self, text: str) -> None:
        if text:
            self.pieces.append(unescape(text))
            self.size += len(self.pieces[-1])

    def _parse(self) -> None:
        source, at, said = self.source, 0, 0
        while m := _TAG.search(source, at):
            tag, begin = (m[2] or "").lower(), m.start()
            if not tag:
                stop = source.find("-->" if m[0] == "<!--" else ">", m.end())
                self._say(source[said:begin])
                at = said = len(source) if stop < 0 else stop + (3 if m[0] == "<!--" else 1)
                continue
            found, end = _attributes(source, m.end())
            self._say(source[said:begin])
            at = said = end
            if end < 0:  # a tag that never ends takes the rest
                said = len(source)
                break
            if m[1]:
                if self.where.get(tag):
                    self._cut(self.where[tag][-1], begin)
            elif tag in NO_TEXT:
                close = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = said = close.end() if close else len(source)
            else:
                self._start(tag, found, begin, end)
        self._say(source[said:])
        self._cut(0, len(source))


def page_tree(html, attributes: tuple[str, ...] = ATTRIBUTES) -> Column:
    """The elements of a page as a struct of :data:`TREE`; a null page has none."""

    @F.arrow_udf(TREE)
    def run(column: pa.Array) -> pa.Array:
        pages = [_Page(x or "", attributes) for x in column.to_pylist()]
        flat = lambda name: [x for p in pages for x in getattr(p, name)]
        ends = lambda parts: pa.array([0, *_sums(map(len, parts))], pa.int32())
        marks, spans = flat("marks"), flat("spans")
        columns = [
            pa.array([k for p in pages for k in range(len(p.last))], pa.int32()), pa.array(flat("last"), pa.int32()), pa.array(flat("parent"), pa.int32()),
            pa.ListArray.from_arrays(ends(marks), pa.array([x for m in marks for x in m], pa.string())), pa.array(flat("href"), pa.string()),
            *(pa.array([s[k] for s in spans], pa.int32()) for k in range(4)),
        ]
        elements = pa.StructArray.from_arrays(columns, names=[f.split()[0] for f in ELEMENT.split(", ")])
        names = [list(dict.fromkeys(x for m in p.marks for x in m)) for p in pages]
        fields = [pa.array(["".join(p.pieces) for p in pages], pa.string()),
                  pa.ListArray.from_arrays(ends(names), pa.array([x for n in names for x in n], pa.string())),
                  pa.ListArray.from_arrays(ends([p.last for p in pages]), elements)]
        return pa.StructArray.from_arrays(fields, names=["text", "names", "elements"])

    return run(F.col(html) if isinstance(html, str) else html)


def _sums(sizes) -> list[int]:
    out, total = [], 0
    for n in sizes:
        total += n
        out.append(total)
    return out
