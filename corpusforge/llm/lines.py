"""Operator 6, line dedup: levelled sorted runs of line hashes.

The store holds runs: tables of 128-bit line keys, bucketed and sorted by key.
A batch reduces its own keys first (one row per key, combined before the
shuffle, so a line that a third of all documents share is one row), then
merge-joins the runs: keys that a run holds belong to an earlier batch, the
rest, those in no run, are new and become a run of level 0.  When a level has ``fanout``
runs they are merged into one run of the next level, so a batch meets few
runs.  Only the batch is shuffled; the runs lie bucketed on disk.

``dedup_lines`` feeds a table to the store in batches of ascending doc_id, so
"held by an earlier batch" means "held by a smaller doc_id".

Defined results: a null or empty text is one empty line; lines whose key has
under ``min_chars`` code points always stay; rows with the same doc_id are one
document; rows without doc_id are one document after all others; extra columns
pass through whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm.files import folder, whole_file
from corpusforge.operators.plan_utils import materialize
from corpusforge.session import scratch_path

STRIP = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
LAST = (1 << 63) - 1
RUN = "k1 bigint, k2 bigint, owner bigint, shared boolean"  # owner: null if an older run holds the key


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit key of a line, or None if its stripped form is too short to count."""
    key = line.strip(STRIP)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return hashlib.md5(key.lower(), usedforsecurity=False).digest()  # bytes.lower: A-Z only


def line_keys(text: Column, min_chars: int) -> Column:
    """The distinct keys of a text's lines, as (k1, k2) pairs."""

    @F.arrow_udf("array<struct<k1: bigint, k2: bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        found, ends = [], [0]
        for t in texts.to_pylist():
            keys = {line_key(x, min_chars) for x in (t or "").encode().split(b"\n")} - {None}
            found += keys
            ends.append(len(found))
        pairs = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
        both = pa.StructArray.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["k1", "k2"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), both)

    return run(text)


def drop_lines(text: Column, gone: Column, min_chars: int) -> Column:
    """Struct of n_lines, n_dropped and the text without the lines whose key is in ``gone``."""

    @F.arrow_udf("n_lines bigint, n_dropped bigint, kept string")
    def run(texts: pa.Array, gone: pa.Array) -> pa.Array:
        total, dropped, kept = [], [], []
        for t, keys in zip(texts.to_pylist(), gone, strict=True):
            lines = (t or "").split("\n")
            total.append(len(lines))
            if keys.is_valid and len(keys.values):
                pairs = np.column_stack([keys.values.field("k1").to_numpy(), keys.values.field("k2").to_numpy()])
                drop = {p.tobytes() for p in pairs}
                lines = [x for x in lines if line_key(x.encode(), min_chars) not in drop]
            dropped.append(total[-1] - len(lines))
            kept.append("\n".join(lines))
        return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                                          names=["n_lines", "n_dropped", "kept"])

    return run(text, gone)


class LineRuns:
    """The levelled store of line keys seen so far, in a folder that a later job can :meth:`open` again.

    Spark knows a run's buckets by a table in its catalog; :meth:`close` drops these
    entries (not the files), and opening the folder makes them anew.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None, root: str | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.root = root or scratch_path(spark, self.name)
        self.levels: list[list[int]] = [[]]
        self.made = 0  # runs written so far; run n lies in <root>/<n>
        self.known: set[int] = set()  # runs in the catalog

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> LineRuns:
        """The store in a folder, as the last finished batch left it."""
        fs, where = folder(root)
        with fs.open_input_file(f"{where}/runs.json") as f:
            state = json.loads(f.read())
        out = cls(spark, state["fanout"], state["buckets"], root)
        out.levels, out.made = state["levels"], state["made"]
        return out

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        for run in self.known:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{run}")
        self.known = set()

    def _save(self) -> None:
        fs, where = folder(self.root)
        with whole_file(fs, f"{where}/runs.json") as out:
            out.write(json.dumps({"fanout": self.fanout, "buckets": self.buckets, "levels": self.levels, "made": self.made}).encode())

    def _table(self, run: int) -> DataFrame:
        if run not in self.known:
            self.spark.sql(f"CREATE TABLE {self.name}_{run} ({RUN}) USING parquet CLUSTERED BY (k1, k2) SORTED BY (k1, k2) INTO {self.buckets} BUCKETS "
                           f"LOCATION '{self.root}/{run}'")
            self.known.add(run)
        return self.spark.table(f"{self.name}_{run}")

    def _write(self, run: DataFrame) -> int:
        self.made += 1
        (run.repartition(self.buckets, "k1", "k2").write.mode("overwrite").option("path", f"{self.root}/{self.made}")
         .bucketBy(self.buckets, "k1", "k2").sortBy("k1", "k2").saveAsTable(f"{self.name}_{self.made}"))
        self.known.add(self.made)
        return self.made

    def _compact(self) -> None:
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                # a key is owned by one run only, so runs merge without comparing rows
                parts = [self._table(r).filter("owner IS NOT NULL") for r in runs]
                merged = parts[0]
                for p in parts[1:]:
                    merged = merged.unionByName(p)
                run = self._write(merged)
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level] = []
                self.levels[level + 1].append(run)

    def add(self, keys: DataFrame) -> DataFrame:
        """Take a batch (``id, k1, k2``); return the ``id, k1, k2`` whose lines must go.

        A key goes from every id of the batch when an earlier batch held it,
        and otherwise from all but the smallest id that holds it.
        """
        own = keys.groupBy("k1", "k2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).withColumn("held", F.lit(False))
        # one merge join per run marks what it holds; the batch, once shuffled and sorted, stays so
        for number in (n for level in self.levels for n in level):
            run = self._table(number).filter("owner IS NOT NULL").select("k1", "k2", F.lit(True).alias("here"))
            own = own.join(run, ["k1", "k2"], "left").select("k1", "k2", "lo", "hi", F.expr("held OR here IS NOT NULL").alias("held"))
        new = own.select("k1", "k2", F.expr("if(held, NULL, lo)").alias("owner"), F.expr("held OR lo < hi").alias("shared"))
        self.levels[0].append(self._write(new))
        # read by path, without the buckets: both sides are shuffled, so Spark can split a key that many documents hold
        shared = self.spark.read.schema(RUN).parquet(f"{self.root}/{self.made}").filter("shared").select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), "owner")
        self._compact()
        self._save()
        return (keys.join(shared, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")))
                .filter("owner IS NULL OR id <> owner").select("id", "k1", "k2"))


def _ranges(keys: DataFrame, batches: int) -> list[tuple[int, int]]:
    """About equal id ranges (inclusive) that together hold every id."""
    cuts = keys.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 1000)).first()[0] if batches > 1 else None
    edges = [-LAST - 1, *sorted(set(cuts or [])), LAST]
    return [(a if i == 0 else a + 1, b) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if i == 0 or a < b]


def dropped_keys(docs: DataFrame, doc_id: str, text: str, batches: int, fanout: int, min_chars: int) -> DataFrame:
    """``id, gone``: for every document that loses lines, the keys of those lines."""
    spark = docs.sparkSession
    keys = docs.select(F.coalesce(docs[doc_id], F.lit(LAST)).alias("id"), line_keys(docs[text], min_chars).alias("keys"))
    keys = materialize(keys, "line-keys")
    ranges = _ranges(keys, batches)
    flat = keys.select("id", F.explode("keys").alias("k")).select("id", "k.k1", "k.k2")
    gone = None
    with LineRuns(spark, fanout) as runs:
        for lo, hi in ranges:
            part = runs.add(flat.filter(F.col("id").between(lo, hi)))
            gone = part if gone is None else gone.unionByName(part)
    return gone.groupBy("id").agg(F.collect_set(F.struct("k1", "k2")).alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = 3, fanout: int = 2,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``row`` (the document's columns), ``n_lines``, ``n_dropped`` and ``kept`` (the text without dropped lines)."""
    gone = dropped_keys(docs, doc_id, text, batches, fanout, min_chars)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"),
                       F.coalesce(docs[doc_id], F.lit(LAST)).alias("id"))
    out = rows.join(gone, "id", "left").select("row", drop_lines(F.col("text"), F.col("gone"), min_chars).alias("x"))
    return out.select("row", "x.*")


def line_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: line counts and the SHA-256 of what is kept."""
    out = dedup_lines(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
