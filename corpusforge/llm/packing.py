"""Operator 8, best-fit packing: sum-of-squares.

Pieces of at most ``capacity`` tokens go into sequences, longest first.  With
N(g) open sequences of residual gap g, a piece of length s that fits some open
sequence goes into the gap where the sum of N(g)**2 becomes smallest: gap g
changes the sum by 2 (N(g - s) - N(g)) + 2.  Full sequences are closed and no
longer counted; a new one is opened only when no open one fits (the aim is as
few sequences as possible; this reaches the lower bound, the tokens divided by
the capacity, to within one sequence on the test documents).

Pieces are dealt evenly to shards of about ``SHARD``, each packed by itself, so
no task grows with the table and a shard costs at most one part-filled
sequence.  Only lengths are shuffled, never texts or ids.

Defined results: a null text is empty and gives the end id alone; equal rows
are packed each for itself; documents without doc_id are packed like any
other; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import encode
from corpusforge.operators.plan_utils import materialize

CAPACITY = 2048
END_ID = 0
SHARD = 50_000  # pieces in a shard, about


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece: full pieces, the shorter one first."""
    head = n % capacity if n > capacity else n
    starts = [0] if head else []
    starts += range(head, n, capacity)
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def pieces(text: Column, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> Column:
    """Array of the pieces of a text: number, start, length and CRC-32 of the ids."""

    @F.arrow_udf("array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint>>")
    def run(column: pa.Array) -> pa.Array:
        out, ends = [], [0]
        for t in column.to_pylist():
            ids = np.append(encode.encode(path, t or "", added=True), np.uint32(end_id)).astype("<u4", copy=False)
            out += [(i, a, n, zlib.crc32(ids[a:a + n])) for i, (a, n) in enumerate(cut(len(ids), capacity))]
            ends.append(len(out))
        cols = list(zip(*out, strict=True)) or [()] * 4
        arrays = [pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, names=["piece", "start", "length", "ids_crc32"]))

    return run(text)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in the order given."""
    count = np.zeros(capacity + 1, np.int64)  # N(g); N(0) stays 0
    by_gap: dict[int, list[int]] = {}
    where, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        gap = 0
        if s < capacity:
            change = 2 * (count[:capacity - s] - count[s:capacity]) + 2
            change[0] -= 1  # an exact fit only takes a sequence away
            change[count[s:capacity] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            gap = s + best if count[s + best] else 0
        if gap:
            where[i], offset[i], left = by_gap[gap].pop(), capacity - gap, gap - s
            count[gap] -= 1
        else:
            where[i], offset[i], left, made = made, 0, capacity - s, made + 1
        if left:
            count[left] += 1
            by_gap.setdefault(left, []).append(int(where[i]))
    return where, offset


def packer(capacity: int):
    """Packs the pieces of one shard."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]).reset_index(drop=True)
        where, pdf["offset"] = sum_of_squares(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = pdf["shard"] * (1 << 32) + where
        return pdf.drop(columns="shard")

    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, shard: int = SHARD) -> DataFrame:
    """One row per piece: its place in its document (``piece, start, length``) and in its sequence (``sequence_id, offset``)."""
    path = path or encode.vocabulary_path()
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.explode(pieces(docs[text], path, capacity, end_id)).alias("p"))
    rows = materialize(rows.select("doc_id", "p.*"), "pieces")
    # the rows lie in files now, so their numbers stay the same when a task is repeated
    shards = max(1, -(-rows.count() // shard))
    rows = rows.withColumn("shard", F.monotonically_increasing_id() % shards)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, offset bigint, sequence_id bigint"
    return rows.groupBy("shard").applyInPandas(packer(capacity), schema)
