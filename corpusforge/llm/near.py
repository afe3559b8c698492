"""Operator 1, near-dedup by Order MinHash.

A text's k-mers are its three-word windows, each labelled with its occurrence
number in the text.  A sketch element takes, under one permutation, the two
smallest labelled k-mers and hashes them in text order, so two texts agree on
it with about the square of their k-mers' similarity, and only if the order
agrees.  Texts that share an element meet in its bucket.  The pair is verified
there by aligning the two texts word by word inside the band that the threshold
allows; similarity = matched words / (na + nb - matched), which is 1 - the
normalised insert-delete distance.  The k-mers are shorter than the five words
that the threshold of 0.8 usually stands for, because the similarity is that of
edits: every pair that agrees in 0.8 of its five-word windows, in order, does so in its
words, but one changed word in ten leaves only half of those windows.  With 24 elements and
two in common asked for, tests find over 0.9 of the pairs whose words agree in 0.80 to 0.82,
and practically all closer ones.  In short texts a changed word spoils most
windows, so their last elements are taken from single words.

Scale: equal texts collapse to one representative before any sketch is
compared.  A bucket is worked through in blocks of at most ``block`` texts,
each pair of blocks a group of its own, so no group is unbounded; a group
emits only links that join two components (at most members - 1), never all
pairs.  Each pair is handled in the first bucket that its texts share.

Defined results: a null text is empty; equal texts are copies, empty ones
too, but a wordless text is near no other; a text of under three words is one
k-mer; rows without doc_id have no class and stay; rows that
share a doc_id are classed each by its own text; extra columns are not read;
an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import words as W
from corpusforge.llm.graph import components
from corpusforge.operators.plan_utils import materialize

SHINGLE = 3
THRESHOLD = 0.8
ELEMENTS = 24
SHORT_ELEMENTS = 8  # of these: of short texts from single words
SHORT = 16  # words
MINIMA = 2
IN_COMMON = 2
MASKED = 4096  # words: up to here an alignment holds where each word stands
BLOCK = 400  # texts in a block: two blocks of very long texts still fit a worker
SEED = 1

_rng = np.random.default_rng(SEED)
_ODD = _rng.integers(0, 1 << 63, ELEMENTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, ELEMENTS, dtype=np.uint64)


def word_hashes(b: np.ndarray) -> np.ndarray:
    """Hashes of the text's words, in text order."""
    return W.span_hashes(b, *W.word_spans(b))[0]


def _numbered(grams: np.ndarray) -> np.ndarray:
    """The k-mers as distinct numbers, in text order: hash and occurrence."""
    order = np.argsort(grams, kind="stable")
    new = np.r_[True, grams[order[1:]] != grams[order[:-1]]] if len(grams) else np.empty(0, bool)
    if not new.all():
        at = np.arange(len(grams))
        nth = np.empty(len(grams), np.uint64)
        nth[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        again = nth > 0  # first occurrences stay as they are in a text without repetition
        grams = grams.copy()
        grams[again] = W.mix(grams[again] + nth[again] * np.uint64(W.BASE))
    return grams


def sketch(words: np.ndarray) -> np.ndarray:
    """Order MinHash of a text: per permutation, the smallest labelled k-mers hashed in text order."""
    long = ELEMENTS if len(words) > SHORT else ELEMENTS - SHORT_ELEMENTS
    out = np.zeros(ELEMENTS, np.uint64)
    _sketch(_numbered(W.shingles(words, SHINGLE)), 0, long, out)
    if long < ELEMENTS:
        _sketch(_numbered(words), long, ELEMENTS, out)
    return out


def _sketch(grams: np.ndarray, first: int, last: int, out: np.ndarray) -> None:
    step = max(1, 4_000_000 // max(1, len(grams)))  # long texts: fewer permutations at once
    for lo in range(first, last, step):
        hi = min(last, lo + step)
        h = grams[None, :] * _ODD[lo:hi, None] + _ADD[lo:hi, None]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(W.BASE)
        if len(grams) > MINIMA:
            at = np.sort(np.argpartition(h, MINIMA - 1, axis=1)[:, :MINIMA], axis=1)
        else:
            at = np.tile(np.arange(len(grams)), (hi - lo, 1))
        # an element only meets its own kind, and k-mers of three words none of one
        x = np.arange(lo, hi, dtype=np.uint64) + np.uint64(ELEMENTS if first else 0)
        for k in range(at.shape[1]):
            x = W.mix(x * np.uint64(W.BASE) + grams[at[:, k]])
        out[lo:hi] = x


def _sketch_array(found: list[np.ndarray]) -> pa.Array:
    ends = np.arange(len(found) + 1, dtype=np.int32) * ELEMENTS
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))


def sketches(text: Column) -> Column:
    """The sketch of a text, or an empty array for a wordless one."""

    @F.arrow_udf("array<bigint>")
    def run(column: pa.Array) -> pa.Array:
        found = [word_hashes(b) for b in W.texts(column)]
        flat = [sketch(x).view(np.int64) for x in found if len(x)]
        ends = np.cumsum([0] + [ELEMENTS * (len(x) > 0) for x in found])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64)))

    return run(text)


def signatures(text: Column) -> Column:
    """Struct of the ``sketch`` of a text with words and of the words themselves (hashes of 32 bits)."""

    @F.arrow_udf("sketch array<bigint>, seq binary")
    def run(column: pa.Array) -> pa.Array:
        found = [word_hashes(b) for b in W.texts(column)]
        seq = [(x >> np.uint64(32)).astype("<u4").tobytes() for x in found]
        return pa.StructArray.from_arrays([_sketch_array([sketch(x).view(np.int64) for x in found]), pa.array(seq, pa.binary())], names=["sketch", "seq"])

    return run(text)


class Sequence:
    """A text's words, sorted once for matching."""

    def __init__(self, raw: bytes):
        self.values = np.frombuffer(raw, "<u4")
        self.n = len(self.values)
        self.at = np.argsort(self.values, kind="stable").astype(np.int32)
        self.sorted = self.values[self.at].astype(np.uint64) << np.uint64(32)
        again = np.r_[False, self.sorted[1:] == self.sorted[:-1]]
        self.distinct = not again.any()
        if not self.distinct:  # equal windows are told apart by their occurrence
            k = np.arange(self.n)
            self.sorted += (k - np.maximum.accumulate(np.where(again, 0, k))).astype(np.uint64)


def _increasing(x: np.ndarray) -> int:
    """Length of the longest increasing run of distinct numbers, gaps allowed."""
    if (np.diff(x) > 0).all():
        return len(x)
    tails: list[int] = []
    for y in x.tolist():
        k = bisect_left(tails, y)
        tails[k:k + 1] = [y]
    return len(tails)


def _common(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence whose matches lie at most ``band`` positions apart.

    Bit-parallel by rows of ``a``: a cleared bit is a column of ``b`` where the
    length grows.  Only the columns inside the band are held, so a row costs
    the band's width in bits, however often its word is repeated.  Where a word
    stands in ``b`` is looked up in a table, or sought within the band in long texts.
    """
    step = max(64, band // 4)  # rows before the held columns move on
    width = 2 * band + 1 + step
    ones = (1 << width) - 1
    lo, held, done = -band, ones, 0  # column of the lowest bit; columns before it count in ``done``
    masks: dict[int, int] | None = None
    if len(b) <= MASKED:
        masks = {}
        for k, x in enumerate(b.tolist()):
            masks[x] = masks.get(x, 0) | 1 << k
    rows = a.tolist()
    for start in range(0, len(a), step):
        shift = start - band - lo
        if shift:
            done += shift - (held & ((1 << shift) - 1)).bit_count()
            held = (held >> shift) | (((1 << shift) - 1) << (width - shift))
            lo += shift
        for i in range(start, min(start + step, len(a))):
            first = max(0, i - band)
            if masks is not None:
                match = (masks.get(rows[i], 0) >> first) & ((1 << (i + band + 1 - first)) - 1)
            else:
                match = int.from_bytes(np.packbits(b[first:i + band + 1] == a[i], bitorder="little").tobytes(), "little")
            if match:
                match = (match << (first - lo)) & held
                held = ((held + match) | (held & ~match)) & ones
    return done + width - held.bit_count()


def similarity(a: Sequence, b: Sequence, threshold: float = THRESHOLD) -> float:
    """Aligned similarity, or 0 where it is below ``threshold``.

    The n-th occurrences of equal words are matched first; no alignment matches
    more.  Where words are distinct within both texts, or all these matches are
    in order, the longest common subsequence is the longest increasing run of
    matched positions; else repeated words may match at any of their places.
    Only matches inside the band of insertions and deletions that the threshold
    allows can be on it.
    """
    total = a.n + b.n
    least = threshold * total / (1 + threshold)  # matched words needed
    if min(a.n, b.n) < least - 1e-9:
        return 0.0
    if a.n > b.n:
        a, b = b, a
    slot = np.minimum(np.searchsorted(b.sorted, a.sorted), b.n - 1)
    same = b.sorted[slot] == a.sorted
    pa_, pb = a.at[same], b.at[slot[same]]
    if len(pb) < least - 1e-9:
        return 0.0
    band = total - 2 * least + 1
    order = np.argsort(pa_, kind="stable")
    pa_, pb = pa_[order], pb[order]
    if (a.distinct and b.distinct) or (np.diff(pb) > 0).all():
        near = np.abs(pa_ - pb) <= band
        matched = _increasing(pb[near])
    else:
        x, y = a.values, b.values
        differ = np.flatnonzero(x != y[:a.n])
        head = int(differ[0]) if len(differ) else a.n  # the same beginning and end match whole
        differ = np.flatnonzero(x[head:][::-1] != y[head:][::-1][:a.n - head])
        tail = int(differ[0]) if len(differ) else a.n - head
        matched = head + tail + _common(x[head:a.n - tail], y[head:b.n - tail], int(band))
    if matched < least - 1e-9:
        return 0.0
    got = matched / (total - matched)
    return got if got >= threshold else 0.0


def _group_links(rows: list, bucket: int, cross: bool) -> list[tuple]:
    """Links of a pair of blocks (``cross``) or of one block with itself that join components."""
    ids, blocks = [r.id for r in rows], np.array([r.block for r in rows])
    sketches, seqs = np.array([r.sketch for r in rows]), [r.seq for r in rows]
    parent = list(range(len(ids)))
    ready: dict[int, Sequence] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def seq(x: int) -> Sequence:
        if x not in ready:
            ready[x] = Sequence(seqs[x])
        return ready[x]

    links = []
    for i in range(len(ids) - 1):
        same = sketches[i + 1:] == sketches[i]
        first = sketches[i][same.argmax(axis=1)]
        ok = (first == bucket) & (same.sum(axis=1) >= IN_COMMON)
        if cross:
            ok &= blocks[i + 1:] != blocks[i]
        for j in (np.flatnonzero(ok) + i + 1).tolist():
            if root(i) != root(j) and (s := similarity(seq(i), seq(j))):
                parent[root(j)] = root(i)
                links.append((ids[i], ids[j], s))
    return links


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over a partition sorted by group: the links of every group."""
    key, held, out = None, [], []
    rows = chain.from_iterable(pdf.itertuples(index=False) for pdf in batches)
    for r in chain(rows, [None]):
        now = r and (r.bucket, r.bi, r.bj)
        if now != key:
            if len(held) > 1:
                out += _group_links(held, key[0], key[1] != key[2])
            key, held = now, []
        if len(out) > 10_000 or r is None:
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])
            out = []
        held.append(r)


def near_links(texts: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Verified links ``a, b`` that span every component, between distinct texts (``id, key, sketch``).

    ``rows`` (``id, key, text``) has their words; only those of texts that share a bucket are looked at again.
    """
    flat = texts.select("id", "key", F.explode("sketch").alias("bucket"))
    sizes = flat.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    member = flat.join(sizes, "bucket").select("id", "key", "bucket", F.ceil(F.col("size") / block).alias("blocks"))
    member = member.withColumn("block", F.expr("pmod(xxhash64(key), blocks)")).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    member = materialize(member.select("id", "key", "bucket", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj")), "members")
    words = rows.join(member.select("id", "key").distinct(), ["id", "key"]).select("id", "key", signatures(F.col("text")).alias("s"))
    words = materialize(words.select("id", "key", "s.*").dropDuplicates(["id", "key"]), "windows")
    full = member.join(words, ["id", "key"]).drop("key")
    full = full.repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj", "id")
    return full.mapInPandas(_links, "a bigint, b bigint, similarity double").select("a", "b")


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the smallest doc_id of its class), ``kept`` and ``key`` (of the text)."""
    rows = docs.select(docs[doc_id].cast("bigint").alias("id"), _key(docs[text]).alias("key"), docs[text].alias("text"))
    base = materialize(rows.select("id", "key", sketches(F.col("text")).alias("sketch")), "sketches")
    # written, so that Spark can split the key of a text that a third of all rows have, or broadcast this side if it is small
    equal = materialize(base.filter("id IS NOT NULL").groupBy("key").agg(F.min("id").alias("id")), "equal")
    texts = base.filter("size(sketch) > 0").join(equal, ["key", "id"]).dropDuplicates(["key"]).select("id", "key", "sketch")
    links = materialize(near_links(texts, rows), "near-links")
    classes = components(links)
    named = materialize(equal.join(classes, equal.id == classes.node, "left").select("key", F.coalesce("component", "id").alias("class")), "named")
    out = base.select("id", "key").join(named, "key", "left")
    out = out.select(F.col("id").alias("doc_id"), F.expr("if(id IS NULL, NULL, class)").alias("class_id"), "key")
    return out.withColumn("kept", F.expr("coalesce(doc_id = class_id, true)"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all its columns; documents without doc_id all stay."""
    # written before it is made distinct: Spark can split the classes' join only where nothing relies on its partitions
    gone = near_classes(docs, doc_id, text).filter("NOT kept").select(F.col("doc_id").alias("g1"), F.col("key").alias("g2"))
    gone = materialize(gone, "gone").distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].alias("id"), _key(docs[text]).alias("key"))
    rows = rows.join(gone, (F.col("id") == F.col("g1")) & (F.col("key") == F.col("g2")), "left_anti")
    # a row that repeats doc_id and text of another is a copy too; rows without doc_id are told apart by a number
    rows = rows.withColumn("alone", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
    return rows.dropDuplicates(["id", "key", "alone"]).select("row.*")
