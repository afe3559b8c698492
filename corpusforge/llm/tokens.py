"""Operator 7, token counts under edits: pre-token segment trees.

A document's pre-tokens (the pieces that the tokenizer's pattern cuts, none of
which shares a token with another) are dealt to leaves of about ``LEAF``
characters; a segment tree holds the token sums above them.  An edit replaces
a span of the text.  Only the leaves that it touches, and neighbours while the
place where they meet is no longer a sure pre-token boundary, are cut and
encoded again; the new leaves take the old ones' place and the sums above them
follow.  A boundary is sure between a character that is no white space and a
space with no white space after it: the pattern never reaches across.

The query's edits are the redaction of personal data and secrets: e-mail
addresses, phone numbers and long keys give way to fixed words.

Defined results: a null or empty text has no tokens; a null edit list changes
nothing; edits are taken in text order, and one that overlaps an earlier one is
refused with an error; repeated rows are counted each for itself; extra columns
are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import encode

LEAF = 512
SURE = re.compile(r"(?<=\S) (?=\S)")

#: What the query edits: pattern and replacement.  A mail address is sought from its ``@``, so that a long run of letters is read once.
MAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
MAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PHONE = re.compile(r"(?<![\w+])\+?\d[\d ()/.-]{7,}\d(?!\w)")
SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{32,}={0,2}")
REDACTIONS = ((PHONE, "[phone]"), (SECRET, "[secret]"))


def leaf_cuts(text: str, size: int = LEAF) -> list[str]:
    """The text in leaves, cut at sure boundaries after at least ``size`` characters."""
    out, at = [], 0
    while at < len(text):
        m = SURE.search(text, at + size)
        stop = m.start() if m else len(text)
        out.append(text[at:stop])
        at = stop
    return out


class TokenTree:
    """Leaves of a text, and sums of characters and tokens over them.

    The sums are heap-ordered over ``width`` (a power of two) leaf places: node
    k has the children 2k and 2k + 1, leaf i is node ``width + i``.  Places stay
    when leaves are joined: the first holds the text, the others are empty.
    """

    def __init__(self, text: str, path: str, size: int = LEAF):
        self.path, self.encoded, self.stale = path, 0, set()
        self.leaves = leaf_cuts(text, size) or [""]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        pad = [0] * (self.width - len(self.leaves))
        self.chars = self._sums([len(x) for x in self.leaves] + pad)
        self.tokens = self._sums([self._encode(x) for x in self.leaves] + pad)

    @staticmethod
    def _sums(level: list[int]) -> list[int]:
        levels = [level]
        while len(level) > 1:
            level = [a + b for a, b in zip(level[::2], level[1::2], strict=True)]
            levels.append(level)
        return [0, *(x for level in reversed(levels) for x in level)]

    def _encode(self, leaf: str) -> int:
        self.encoded += len(leaf)
        return len(encode.encode(self.path, leaf))

    def _set(self, sums: list[int], leaf: int, value: int) -> None:
        k = self.width + leaf
        change = value - sums[k]
        while k:
            sums[k] += change
            k //= 2

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one with text, past the end), and where it starts."""
        at = min(at, max(0, self.chars[1] - 1))
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if at >= start + self.chars[k]:
                start += self.chars[k]
                k += 1
        return k - self.width, start

    def _put(self, leaf: int, text: str) -> None:
        self.leaves[leaf] = text
        self.stale.add(leaf)
        self._set(self.chars, leaf, len(text))

    def _beside(self, leaf: int, step: int) -> int | None:
        """The next leaf with text on one side."""
        leaf += step
        while 0 <= leaf < len(self.leaves):
            if self.leaves[leaf]:
                return leaf
            leaf += step
        return None

    def _replace(self, start: int, end: int, new: str) -> None:
        lo, origin = self._find(start)
        hi = max(lo, self._find(end - 1)[0]) if end > start else lo
        body = "".join(self.leaves[lo:hi + 1])
        body = body[:start - origin] + new + body[end - origin:]
        # boundary context: take in neighbours while a pre-token may reach across the seam
        while (left := self._beside(lo, -1)) is not None and not _seam(self.leaves[left], body):
            lo, body = left, self.leaves[left] + body
        while (right := self._beside(hi, 1)) is not None and not _seam(body, self.leaves[right]):
            hi, body = right, body + self.leaves[right]
        for k in range(lo + 1, hi + 1):
            if self.leaves[k]:
                self._put(k, "")
        self._put(lo, body)

    def edit(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Replaces spans [start, end) of the present text, then encodes the touched leaves again."""
        edits = sorted(edits)
        if any(a[1] > b[0] for a, b in zip(edits, edits[1:], strict=False)):
            raise ValueError("edits overlap")
        for start, end, new in reversed(edits):  # from the right: positions further left stay valid
            self._replace(start, end, new)
        for leaf in self.stale:
            self._set(self.tokens, leaf, self._encode(self.leaves[leaf]))
        self.stale = set()

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)


def _seam(left: str, right: str) -> bool:
    """Whether no pre-token can reach from ``left`` into ``right``."""
    return bool(SURE.match(left[-1:] + right[:2], 1))


def mail_addresses(text: str) -> Iterator[tuple[int, int]]:
    """Spans of a name, ``@`` and a host with a dot, from left to right."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in MAIL_NAME:
            start -= 1
        host = MAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            last = host.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Spans of personal data and secrets, and what stands in for them."""
    found = [(a, b, "[email]") for a, b in mail_addresses(text)]
    for pattern, new in REDACTIONS:
        found += [(m.start(), m.end(), new) for m in pattern.finditer(text)]
    out: list[tuple[int, int, str]] = []
    for span in sorted(found):  # of overlapping spans the first stays
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


COUNTS = "n_tokens bigint, n_edits bigint, n_tokens_edited bigint, n_chars_reencoded bigint"


def _counts(text: str | None, edits: list[tuple[int, int, str]], path: str) -> tuple[int, int, int, int]:
    tree = TokenTree(text or "", path)
    before, tree.encoded = tree.total, 0
    tree.edit(edits)
    return before, len(edits), tree.total, tree.encoded


def _struct(rows: list[tuple]) -> pa.Array:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[x.split()[0] for x in COUNTS.split(", ")])


def edited_counts(text: Column, edits: Column, path: str) -> Column:
    """Struct of :data:`COUNTS` for edits given as an array of (start, end, replacement) structs."""

    @F.arrow_udf(COUNTS)
    def run(texts: pa.Array, edits: pa.Array) -> pa.Array:
        both = zip(texts.to_pylist(), edits.to_pylist(), strict=True)
        return _struct([_counts(t, [tuple(e.values()) for e in own or ()], path) for t, own in both])

    return run(text, edits)


def redacted_counts(text: Column, path: str) -> Column:
    """Struct of :data:`COUNTS` for the redaction of a text."""

    @F.arrow_udf(COUNTS)
    def run(texts: pa.Array) -> pa.Array:
        return _struct([_counts(t, redactions(t or ""), path) for t in texts.to_pylist()])

    return run(text)


def count_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: its tokens before and after redaction, and what was encoded again."""
    c = redacted_counts(docs[text], path or encode.vocabulary_path())
    return docs.select(docs[doc_id].alias("doc_id"), c.alias("c")).select("doc_id", "c.*")
