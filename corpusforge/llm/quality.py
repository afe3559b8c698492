"""Operator 9, quality rules: repetition coverage.

Every text is measured once, inside its own row: rolling hashes of 5- to
10-word windows (each length grown from the one before it) mark the words that
lie in a window found twice or more, and line hashes mark lines equal to an
earlier line.  The verdict compares the characters covered with fixed shares.

Defined results: a null or empty text has no words and fails the base rule;
extra columns pass through untouched, whatever their names; an empty table
gives an empty table; repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import words as W

#: Share of word characters, in percent, that windows of so many words may cover when found twice or more.
NGRAM_LIMITS = {5: 20, 6: 20, 7: 18, 8: 18, 9: 16, 10: 16}
#: Share of word characters, in percent, in lines equal to an earlier line.
LINE_LIMIT = 30
MIN_WORDS = 10
MAX_REPEAT = 20

MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "base_failed boolean, kept boolean")


def _first_seen(hashes: np.ndarray) -> np.ndarray:
    """True where the value did not occur earlier."""
    first = np.zeros(len(hashes), bool)
    first[np.unique(hashes, return_index=True)[1]] = True
    return first


def _covered(grams: np.ndarray, n: int, n_words: int) -> np.ndarray | None:
    """Words inside n-word windows found twice or more; None if there is no such window."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return None
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    step = np.zeros(n_words + 1, np.int32)
    step[at] += 1
    np.subtract.at(step, at + n, 1)
    return np.cumsum(step[:-1]) > 0


def measure(b: np.ndarray) -> tuple:
    """All measures of one text, given as UTF-8 bytes."""
    starts, ends = W.word_spans(b)
    n = len(starts)
    words, points = W.span_hashes(b, starts, ends)
    chars, symbols = int(points.sum()), int(np.count_nonzero(W.IS_SYMBOL[b]))

    breaks = np.flatnonzero(b == 10)
    line_start, line_end = np.r_[0, breaks + 1], np.r_[breaks, len(b)]
    first_word = np.searchsorted(starts, line_start)
    last_word = np.searchsorted(starts, line_end)
    with_word = last_word > first_word
    lines, _ = W.span_hashes(b, line_start[with_word], line_end[with_word])
    again = ~_first_seen(lines)
    dup_lines = int(again.sum())
    dup_line_chars = 0
    if dup_lines:
        before = np.r_[0, np.cumsum(points)]
        dup_line_chars = int((before[last_word[with_word][again]] - before[first_word[with_word][again]]).sum())

    repeat, verdict = 0, 100 * dup_line_chars <= LINE_LIMIT * chars
    grams = W.shingles(words, 5) if n >= 5 else words[:0]
    for k, limit in NGRAM_LIMITS.items():
        if n < k:
            break
        if k > 5:
            grams = W.grow(grams, words, k)
        inside = _covered(grams, k, n)
        if inside is None:  # then no longer window is found twice either
            break
        if k == 5:
            repeat = int(inside.sum())
        verdict &= 100 * int(points[inside].sum()) <= limit * chars
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT * n
    return n, chars, symbols, dup_lines, repeat, failed, bool(verdict and not failed)


def quality_measures(text: Column) -> Column:
    """Struct column of the measures (see :data:`MEASURES`) of a text column."""

    @F.arrow_udf(MEASURES)
    def run(column: pa.Array) -> pa.Array:
        rows = list(zip(*map(measure, W.texts(column)), strict=True)) or [()] * 7
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
        names = [x.split()[0] for x in MEASURES.split(", ")]
        return pa.StructArray.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=names)

    return run(text)


def quality_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and its measures."""
    q = docs.select(docs[doc_id].alias("doc_id"), quality_measures(docs[text]).alias("q"))
    return q.select("doc_id", "q.*")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    q = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), quality_measures(docs[text]).alias("q"))
    return q.filter("q.kept").select("row.*")
