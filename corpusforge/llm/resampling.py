"""Operator 11, importance resampling towards a target distribution.

A text's features are its words and pairs of consecutive words, hashed into
``BUCKETS`` buckets by CRC-32.  Both corpora are counted once, in arrays inside
the tasks; a bucket's gain is the scaled, floored logarithm of how much more
frequent it is in the target.  A second pass scores every document by array
look-ups: its weight is the floored mean gain of its features.  Adding a Gumbel
variable that follows from its id makes "the highest scores" a weighted
draw without replacement.

The draw is exact, by parallel sorting by regular sampling.  The scored rows
are written in locally sorted runs; every run gives rows at regular distances,
of which the splitters are taken, again at regular distances; runs are
exchanged by segment between splitters and each segment is ordered by itself;
a segment's rows start after the rows of all segments before it (prefix
counts).  Rows are compared by score, id, run and place in the run, so no two
are equal, and equal scores or ids that a third of all rows share are split like
any others.  Segments behind the last drawn row are not ordered at all.

The driver sees the fixed number of buckets, ``SAMPLES`` splitter candidates at
most and one row per segment, whatever the size of the tables.

Defined results: a null or empty text has no features and weight 0; a null id
counts as the empty string in the digest and comes last among equal scores;
equal rows are documents of their own; an empty target gives gains as with
counts of zero; extra columns are not read; an empty table gives an empty
table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm import words as W
from corpusforge.operators.plan_utils import materialize

BUCKETS = 10_000
SCALE = 1000
MIN_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
BLOCK = 1 << 21  # bytes that are looked at together
LONG_WORD = 64  # bytes; longer words are hashed one by one
SAMPLES = 1 << 16  # splitter candidates, over all runs
RUN_SAMPLES = 256  # of these from one run, at most

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IN_WORD = np.zeros(256, bool)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    IN_WORD[_first:_last + 1] = True
IN_WORD |= IN_WORD[LOWER]


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = _crc_table()
ALL = np.uint32(0xFFFFFFFF)


def _step(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return CRC[(state ^ byte) & 255] ^ (state >> 8)


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC-32 registers after each word's bytes, a byte of all words at a time."""
    out = state.copy()
    long = sizes > LONG_WORD
    for i in np.flatnonzero(long).tolist():
        out[i] = zlib.crc32(data[starts[i]:starts[i] + sizes[i]], int(state[i] ^ ALL)) ^ int(ALL)
    order = np.argsort(np.where(long, 0, -sizes), kind="stable")
    held, at, size = out[order], starts[order], np.where(long, 0, sizes)[order]
    for j in range(int(size[0]) if len(size) else 0):
        k = int(np.searchsorted(-size, -j, "left"))
        held[:k] = _step(held[:k], data[at[:k] + j])
    out[order] = held
    return out


def _parts(data: np.ndarray, starts: np.ndarray, block: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``block`` that cut no word."""
    lo = 0
    while lo < len(data):
        hi = lo + block
        while hi < len(data):
            stop = int(starts[np.searchsorted(starts, hi)])  # a text's start
            outside = np.flatnonzero(~IN_WORD[data[hi:min(stop, hi + block)]])
            if len(outside) or stop <= hi + block:
                hi = hi + int(outside[0]) if len(outside) else stop
                break
            hi += block
        yield lo, min(hi, len(data))
        lo = hi


def features(data: np.ndarray, starts: np.ndarray, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Over the texts ``data[starts[i]:starts[i + 1]]``, in parts: buckets of the words and their texts, buckets of the pairs and their texts."""
    last = (0, -1)  # register and text of the last word so far
    for lo, hi in _parts(data, starts, block):
        part = LOWER[data[lo:hi]]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = IN_WORD[part]
        begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        edge = starts[np.searchsorted(starts, lo, "right"):np.searchsorted(starts, hi)] - lo  # texts that start within the part
        begins[edge] = inside[edge + 1]
        ends[edge - 1] = inside[edge]
        at = np.flatnonzero(begins)
        size = np.flatnonzero(ends) + 1 - at
        text = np.searchsorted(starts, at + lo, "right") - 1
        one = crc_on(np.full(len(at), ALL, np.uint32), part, at, size)
        before = np.concatenate((np.array([last[0]], np.uint32), one[:-1])) if len(at) else one
        same = np.concatenate(([last[1]], text[:-1])) == text if len(at) else np.zeros(0, bool)
        two = crc_on(_step(before[same], 0x20), part, at[same], size[same])
        if len(at):
            last = int(one[-1]), int(text[-1])
        yield (one ^ ALL) % np.uint32(BUCKETS), text, (two ^ ALL) % np.uint32(BUCKETS), text[same]


def bucket_counts(table: DataFrame, text: str = "text") -> DataFrame:
    """``bucket, n``: how many features of the table's texts each bucket has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for one, _, two, _ in features(*W.flat(batch.column(0))):
                n += np.bincount(one, minlength=BUCKETS) + np.bincount(two, minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some])], names=["bucket", "n"])

    return table.select(table[text]).mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """Per bucket: the floored, scaled logarithm of its smoothed frequency in the target over that in the source."""
    s, t = sum(source.values()), sum(target.values())
    ratio = ((target.get(b, 0) + 1) * (s + BUCKETS) / ((source.get(b, 0) + 1) * (t + BUCKETS)) for b in range(BUCKETS))
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


WEIGHED = "n_words bigint, n_features bigint, weight bigint"


def weights(text: Column, gain: np.ndarray) -> Column:
    """Struct of a text's words, features and weight (the floored mean gain of its features)."""

    @F.arrow_udf(WEIGHED)
    def run(texts: pa.Array) -> pa.Array:
        words, pairs, total = (np.zeros(len(texts), np.int64) for _ in range(3))
        for one, at, two, at2 in features(*W.flat(texts)):
            words += np.bincount(at, minlength=len(texts))
            pairs += np.bincount(at2, minlength=len(texts))
            for bucket, where in ((one, at), (two, at2)):
                np.add.at(total, where, gain[bucket])
        n = words + pairs
        return pa.StructArray.from_arrays([pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))], names=[c.split()[0] for c in WEIGHED.split(", ")])

    return run(text)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A document's scaled, floored Gumbel variable, from a digest of seed and id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(float(-SCALE)) * F.log(-F.log(u)))


def _sort_key(*columns: np.ndarray) -> np.ndarray:
    """Rows of signed 64-bit numbers as byte strings in the same order."""
    rows = np.column_stack([c.astype(np.int64).view(np.uint64) ^ (np.uint64(1) << np.uint64(63)) for c in columns])
    return rows.astype(">u8", order="C").view(f"S{8 * len(columns)}").ravel()


def segment_of(splitters: np.ndarray, *columns: Column) -> Column:
    """The number of splitters up to each row."""

    @F.arrow_udf("int")
    def run(*arrays: pa.Array) -> pa.Array:
        key = _sort_key(*[a.to_numpy(zero_copy_only=False) for a in arrays])
        return pa.array(np.searchsorted(splitters, key, "right").astype(np.int32))

    return run(*columns)


def top_ranks(rows: DataFrame, order: list[str], asked: str, percent: int) -> DataFrame:
    """``rows`` and ``rank``: the exact place, from 1, of the first ``percent`` of the ``asked`` rows in ascending ``order``; null for the others.

    The columns of ``order`` are whole numbers without nulls.
    """
    spark, full = rows.sparkSession, [*order, "run", "place"]
    # locally sorted runs, written with their number and every row's place, so that these stay when a task is repeated
    runs = rows.sortWithinPartitions(F.col(asked).desc(), *order).withColumn("run", F.spark_partition_id().cast("bigint"))
    runs = materialize(runs.withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "runs")
    lengths = materialize(runs.filter(asked).groupBy("run").agg(F.count("*").alias("n")), "run-lengths")
    n_runs, total = lengths.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    last = percent * total // 100

    # rows at regular distances of every run (of every few runs, if there are more runs than samples)
    each, few = max(1, min(RUN_SAMPLES, SAMPLES // max(1, n_runs))), -(-n_runs // SAMPLES) or 1
    step = F.ceil(F.col("n") / each)
    sample = runs.filter(asked).join(lengths.filter(F.col("run") % few == 0), "run").filter(F.col("place") % step == step - 1)
    found = np.sort(_sort_key(*np.array(sample.select(*full).collect(), np.int64).reshape(-1, len(full)).T))
    segments = max(1, min(len(found), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    splitters = found[[len(found) * i // segments for i in range(1, segments)]]

    # the exchange: a segment's part of every run meets, and is put in order there
    dealt = runs.withColumn("segment", F.when(F.col(asked), segment_of(splitters, *[F.col(c) for c in full])))
    sizes = {r.segment: r.n for r in dealt.filter(asked).groupBy("segment").agg(F.count("*").alias("n")).collect()}
    upto = np.cumsum([sizes.get(i, 0) for i in range(segments)])
    before = [(i, int(upto[i]) - sizes.get(i, 0)) for i in range(segments)]
    needed = [(i, n) for i, n in before if n < last]
    starts = spark.createDataFrame(needed, "segment int, before bigint")
    local = F.row_number().over(Window.partitionBy("segment").orderBy(*full))
    first = dealt.filter(F.col("segment") < len(needed)).join(F.broadcast(starts), "segment").withColumn("rank", F.col("before") + local)
    first = first.withColumn("rank", F.when(F.col("rank") <= last, F.col("rank")))
    rest = dealt.filter(F.coalesce(F.col("segment") >= len(needed), F.lit(True))).withColumn("rank", F.lit(None).cast("bigint"))
    return first.select(*rows.columns, "rank").unionByName(rest.select(*rows.columns, "rank"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score`` and its ``rank`` in the draw (null if not drawn)."""
    counts = [{r.bucket: r.n for r in bucket_counts(t, c).collect()} for t, c in ((docs, text), (target, target_text))]
    w = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), weights(docs[text], gains(*counts)).alias("w"))
    score = (F.col("w.weight") + gumbel(F.col("doc_id"), seed)).alias("score")
    scored = w.select("doc_id", "w.n_features", "w.weight", score, (F.col("w.n_words") >= min_words).alias("asked"))
    order = {"o1": -F.col("score"), "o2": F.col("doc_id").isNull().cast("bigint"), "o3": F.coalesce("doc_id", F.lit(0))}
    out = top_ranks(scored.withColumns(order), [*order], "asked", percent)
    return out.select("doc_id", "n_features", "weight", "score", "rank")
