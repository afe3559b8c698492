"""Plan-shaping helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.session import checkpoint_dir, scratch_path


def filter_computed(df: DataFrame, cond: Column) -> DataFrame:
    """Filter on columns that the projection below computes with expensive
    expressions (regex chains, folds), evaluating them once.

    Catalyst pushes a filter below a deterministic projection by inlining the
    aliased expressions, so a gate on cleaned text would clean every row twice
    (once in the filter, once in the projection).  A non-deterministic column
    (the partition id) in the projection stops that rewrite; the filter then
    reads the computed values.  The filter references the column (always
    true) so column pruning cannot remove it; it is dropped right after.
    """
    tagged = df.withColumn("_cf_pid", F.spark_partition_id())
    return tagged.filter(cond & (F.col("_cf_pid") >= 0)).drop("_cf_pid")


def explode_computed(df: DataFrame, array_col: Column, keep: list, pos: str | None = "pos",
                     value: str = "value", one_based: bool = True) -> DataFrame:
    """``posexplode`` of a computed array without the inferred pre-filter.

    For ``explode``/``posexplode`` Catalyst infers ``size(array) > 0`` and pushes
    it down, inlining the whole array expression below the generator (often
    into the scan, even under a repartition).  The outer variant infers
    nothing; its one null row per empty array is dropped by a filter on the
    generated position, which cannot move below the generator.
    """
    p = pos or "_ec_pos"
    out = df.select(*keep, F.posexplode_outer(array_col).alias(p, value)).filter(F.col(p).isNotNull())
    if pos is None:
        return out.drop(p)
    if one_based:
        out = out.withColumn(p, (F.col(p) + 1).cast("bigint"))
    return out


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used before multi-pass operators (the exact split reads its input twice)
    when the input is expensive to recompute (cleaned text).  Cuts lineage
    too: a lost executor re-reads the table instead of re-cleaning.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`materialize` wrote, once nothing reads it any more; other tables stay.

    The driver's JVM is told to collect its garbage, since Spark deletes the
    shuffle files of finished stages only when their plans are collected.
    """
    spark = tables[0].sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    own = jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark)).toUri().getPath().rstrip("/") + "/"
    for folder in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(own):
            path.getFileSystem(conf).delete(path, True)
    jvm.System.gc()


def with_pinned(df: DataFrame, cols: dict) -> DataFrame:
    """Add ``cols`` in a projection that Catalyst keeps separate from its consumers.

    Catalyst inlines a projection into the next one when each alias is used
    once.  That is harmful when the consumer is a higher-order function
    (``transform``/``filter``/``aggregate`` are interpreted, with no common
    subexpression elimination): the inlined regex chain then runs outside
    code generation, and sub-expressions it repeats run repeatedly.  A
    partition-id marker in the same projection, read by :func:`pinned`,
    stops the inlining.  Drop ``_pin`` when done.
    """
    return df.withColumns({**cols, "_pin": F.spark_partition_id()})


def pinned(col: Column) -> Column:
    """Reference a column added by :func:`with_pinned` (keeps the projection apart)."""
    return F.when(F.col("_pin") >= 0, col)
