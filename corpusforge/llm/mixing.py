"""Operator 2, mixing sources to target weights: capped water-filling.

Targets share all words of the table by weight; a source whose target exceeds
``max_epochs`` times its words is clamped there and the excess goes to the
others by weight, until no target is above its cap.  A source then takes every
document ``floor(target / words)`` times, and once more those documents that
come first in a seeded order, up to the point nearest to the target.

Everything is DataFrame code.  The seeded order is never sorted as a whole:
words are summed per source and order bucket (at most ``4096`` rows a source),
which gives the one bucket where the target is reached; only that bucket's
documents, 1/4096 of a source, are ordered.  The driver sees one row of sums
per clamping round.

Defined results: a null text has size 0; documents without a source form one
source, the last; equal rows are separate documents; sources of size 0 have
target 0; an empty table gives an empty table; other columns stay inside the
``row`` struct, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusforge.operators.plan_utils import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
DIGITS = 3  # hexadecimal digits of the order key that name its bucket


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``source, source_size, rank`` (from 0, by code point, null last) without sorting in one task."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # written with its range number, so the ranges stay as they were when a task is repeated
    parts = materialize(total.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    before = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return parts.join(before, "part").select("source", "source_size", (F.col("before") + local - 1).alias("rank"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` by capped water-filling."""
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = materialize(ranked_sources(sizes).select("source", "source_size", pick.cast("bigint").alias("w"), (F.col("source_size") * max_epochs).alias("cap")), "weights")
    total, weight = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(1))).first()
    rest, clamped = total, 0
    while True:
        level = F.col("w") * F.lit(rest).cast("bigint") / F.lit(weight).cast("bigint")
        over = level > F.col("cap")
        n, caps, free = s.agg(F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
                              F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0))).first()
        if n == clamped or not free:
            break
        rest, weight, clamped = total - caps, free, n
    return s.select("source", "source_size", F.when(over, F.col("cap").cast("double")).otherwise(level).alias("target"))


def _plan(sizes: DataFrame, weights: tuple, max_epochs: int) -> DataFrame:
    """Per source: whole repetitions, words still needed, and the order bucket in which they are reached."""
    t = targets(sizes, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    t = t.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    sums = sizes.groupBy("source", F.substring("h", 1, DIGITS).alias("bucket")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    sums = sums.withColumn("upto", upto).withColumnRenamed("source", "src")
    cut = t.join(sums, F.col("source").eqNullSafe(F.col("src")) & (F.col("upto") > F.col("need")))
    first = F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")), "bucket")
    cut = cut.groupBy("src").agg(first.alias("cut"))
    return t.join(cut, F.col("source").eqNullSafe(F.col("src")), "left").select(F.col("source").alias("src"), "source_size", "target", "whole", "need", "cut.*")


def measured(docs: DataFrame, row: Column, doc_id: str, text: str, source: str) -> DataFrame:
    """``row, source, size, h`` (the seeded order key) of every document."""
    h = F.md5(F.concat_ws(":", F.lit(SEED), docs[doc_id].cast("string"), F.md5(docs[text])))
    size = F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select(row.alias("row"), docs[source].alias("source"), size.alias("size"), h.alias("h"))


def apply_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``source_size, target, copies`` and ``taken`` to ``row, source, size, h``."""
    j = rows.join(plan, F.col("source").eqNullSafe(F.col("src"))).withColumn("bucket", F.substring("h", 1, DIGITS))
    at_cut = F.coalesce(F.col("bucket") == F.col("cut_bucket"), F.lit(False))
    sure = j.filter(~at_cut).withColumn("extra", F.coalesce(F.col("bucket") < F.col("cut_bucket"), F.lit(False)))
    order = Window.partitionBy("src").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = j.filter(at_cut).withColumn("before", F.col("cut_before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    # the document at the edge is taken if that comes nearer to the target
    edge = edge.withColumn("extra", 2 * F.col("before") + F.col("size") <= 2 * F.col("need")).drop("before")
    out = sure.unionByName(edge).withColumn("copies", F.col("whole").cast("bigint") + F.col("extra").cast("bigint"))
    return out.select("row", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_plan(rows: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The per-source plan, written once: Spark knows its size and broadcasts it only if that is small."""
    plan = _plan(rows.select("source", "size", "h"), weights, max_epochs)
    return materialize(plan.withColumnRenamed("bucket", "cut_bucket").withColumnRenamed("before", "cut_before"), "mix-plan")


def mix_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` and the number of copies."""
    rows = materialize(measured(docs, F.struct(docs[doc_id].alias("doc_id")), doc_id, text, source), "mix-sizes")
    out = apply_plan(rows, mix_plan(rows))
    return out.select("row.doc_id", "size", "source_size", "target", "taken", "copies")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every document as many times as it is taken, with all its columns."""
    sizes = materialize(measured(docs, F.lit(None).cast("string"), doc_id, text, source).drop("row"), "mix-sizes")
    rows = measured(docs, F.struct(*[docs[c] for c in docs.columns]), doc_id, text, source)
    out = apply_plan(rows, mix_plan(sizes)).filter("copies > 0")
    return out.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select("row.*")
