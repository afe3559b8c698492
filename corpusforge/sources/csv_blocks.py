"""S2 over large CSV files: one file is read by many tasks although its values hold line breaks.

A line break ends a row only outside quotes, so where a block's first row starts
depends on all quotes before it.  A first pass counts the quotes of every
block; a running sum per file (one small row per block) tells whether a
block starts inside quotes; the second pass parses, from every block, the rows
whose preceding line break lies in it, reading on past its end for the last one.

Rules, as for the unsplit scan: quotes inside quotes are doubled, the first row of each
file is the header, blank lines are no rows, an empty value is null, quoted or
not, rows with too few values are filled with nulls, those with too many are
cut, and a value that is not of its column's type is null.  A quote inside a
value without quotes around it is not valid CSV.  Compressed files cannot
be split and are not read.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.csv as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from corpusforge.operators.plan_utils import materialize

BLOCK = 32 << 20  # bytes
STEP = 1 << 16  # bytes read at a time in search of a row's end
TASKS = 20_000
QUOTE, BREAK = ord('"'), ord("\n")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _csv_files(path: str) -> list[tuple[str, int]]:
    """``path`` itself, or the folder's files whose names Spark would read, with their sizes."""
    fs, root = _open(path)
    one = fs.get_file_info(root)
    if one.type == pafs.FileType.File:
        return [(path, one.size)]
    found = fs.get_file_info(pafs.FileSelector(root))
    return [(f"{path.rstrip('/')}/{f.base_name}", f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "_."]


def row_breaks(data: np.ndarray, quoted: bool) -> np.ndarray:
    """Places of the line breaks outside quotes; ``quoted``: whether the bytes start inside quotes."""
    at = np.flatnonzero(data == BREAK)
    before = np.searchsorted(np.flatnonzero(data == QUOTE), at)  # quotes before each line break
    return at[(before + quoted) % 2 == 0]


def own_rows(f: pa.NativeFile, start: int, end: int, quoted: bool, size: int) -> bytes:
    """The rows whose preceding line break lies in ``start <= at < end``, whole; the file's first row counts as row of its first block."""
    f.seek(start)
    data = f.read(end - start)
    block = np.frombuffer(data, np.uint8)
    breaks = row_breaks(block, quoted)
    if start == 0:
        first = 0
    elif len(breaks):
        first = int(breaks[0]) + 1
    else:
        return b""
    quoted = bool((np.count_nonzero(block == QUOTE) + quoted) % 2)
    out, at = [data[first:]], end
    while at < size:  # the row that the block's end cuts
        more = f.read(STEP)
        piece = np.frombuffer(more, np.uint8)
        ends = row_breaks(piece, quoted)
        if len(ends):
            out.append(more[:int(ends[0]) + 1])
            break
        quoted = bool((np.count_nonzero(piece == QUOTE) + quoted) % 2)
        out.append(more)
        at += len(more)
    return b"".join(out)


def parse(data: bytes, columns: int, header: bool) -> Iterator[pa.RecordBatch]:
    """Rows of text columns ``c0, c1, …``; those with too few or too many values come last."""
    odd: list[str] = []

    def keep(row) -> str:
        odd.append(row.text)
        return "skip"

    names = [f"c{i}" for i in range(columns)]
    kinds = pa.schema([(n, pa.string()) for n in names])
    if header:
        ends = row_breaks(np.frombuffer(data, np.uint8), False)
        data = data[int(ends[0]) + 1:] if len(ends) else b""
    if data.strip(b"\r\n"):
        table = pc.read_csv(pa.BufferReader(data), pc.ReadOptions(use_threads=False, block_size=len(data) + 1, column_names=names),
                            pc.ParseOptions(newlines_in_values=True, invalid_row_handler=keep),
                            pc.ConvertOptions(column_types=kinds, null_values=[""], strings_can_be_null=True, check_utf8=False))
        yield from table.to_batches(max_chunksize=1000)
    if odd:
        rows = [next(csv.reader(io.StringIO(t, newline=""), strict=False), []) for t in odd]
        rows = [[v or None for v in r[:columns]] + [None] * (columns - len(r)) for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)


def read_csv_blocks(spark: SparkSession, path: str, schema: str | TY.StructType, block: int = BLOCK) -> DataFrame:
    """A CSV file, or a folder of them, by blocks of ``block`` bytes; ``schema`` names and types the columns in order."""
    kinds = TY.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    n = len(kinds.fields)
    files = _csv_files(path)
    tasks = max(1, min(sum(-(-size // block) for _, size in files), TASKS))
    blocks = spark.createDataFrame(files, "path string, size long").filter("size > 0")
    blocks = blocks.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block).cast("long"))).alias("start"))
    blocks = blocks.withColumn("end", F.least(F.col("start") + block, "size")).repartition(tasks, "path", "start")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = []
            for r in batch.to_pylist():
                fs, name = _open(r["path"])
                with fs.open_input_file(name) as f:
                    f.seek(r["start"])
                    quotes.append(f.read(r["end"] - r["start"]).count(b'"'))
            yield batch.append_column("quotes", pa.array(quotes, pa.int64()))

    counted = materialize(blocks.mapInArrow(count, "path string, size long, start long, end long, quotes long"), "csv-blocks")
    before = F.expr("coalesce(sum(quotes) OVER (PARTITION BY path ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)")
    placed = counted.withColumn("quoted", before % 2 == 1).repartition(tasks, "path", "start")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, name = _open(r["path"])
                with fs.open_input_file(name) as f:
                    data = own_rows(f, r["start"], r["end"], r["quoted"], r["size"])
                yield from parse(data, n, r["start"] == 0)

    out = placed.mapInArrow(rows, ", ".join(f"c{i} string" for i in range(n)))
    return out.select(*[F.col(f"c{i}").try_cast(f.dataType).alias(f.name) for i, f in enumerate(kinds.fields)])
