"""Dataset statistics.

All counts are aggregates with a map-side partial phase, so a source or
category holding a third of the rows costs one partial row per task, not a
hot reducer.  The stats document is assembled from those small aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Count per non-null value, most frequent first (ties by value)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc(col))
    )


def source_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "source")


def category_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "category")


def stats_grouping_sets(split_df: DataFrame) -> DataFrame:
    """G3-G5 in one pass: ``GROUPING SETS ((split), (source), (category), ())``.

    Output ``kind, key, n`` with kind in split/source/category/total.  Null
    sources and categories are excluded, as in the per-column counts.
    """
    g = split_df.groupingSets(
        [["split"], ["source"], ["category"], []],
        "split",
        "source",
        "category",
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid"))
    # grouping_id bits (split, source, category): 0b011 -> split, 0b101 -> source, 0b110 -> category
    kind = (
        F.when(F.col("_gid") == 3, "split")
        .when(F.col("_gid") == 5, "source")
        .when(F.col("_gid") == 6, "category")
        .otherwise("total")
    )
    key = F.coalesce(
        F.when(F.col("_gid") == 3, F.col("split")),
        F.when(F.col("_gid") == 5, F.col("source")),
        F.when(F.col("_gid") == 6, F.col("category")),
        F.lit(""),
    )
    # a null source/category forms its own group; value counts exclude it
    null_group = (
        F.when(F.col("_gid") == 5, F.col("source").isNull())
        .when(F.col("_gid") == 6, F.col("category").isNull())
        .otherwise(F.lit(False))
    )
    return g.filter(~null_group).select(kind.alias("kind"), key.alias("key"), F.col("n").cast("bigint").alias("n"))


def dataset_stats(df: DataFrame) -> DataFrame:
    """G6 without ranking any row: the split sizes of an exact split depend
    only on the row count (``int(0.7n)``, ``int(0.85n)``), so one grouping-sets
    aggregate over source and category gives the whole stats document.
    Output rows ``kind, key, n`` (total/train/validation/test, sources, categories): the
    document never is one row, its sites and categories grow with the crawl."""
    g = df.groupingSets([["source"], ["category"], []], "source", "category").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid")
    )
    # grouping_id bits (source, category): 0b01 -> source, 0b10 -> category, 0b11 -> total
    g = g.filter(
        ~(((F.col("_gid") == 1) & F.col("source").isNull()) | ((F.col("_gid") == 2) & F.col("category").isNull()))
    )
    n = F.col("n").cast("bigint")
    cut1 = F.floor(F.lit(0.7) * n).cast("bigint")
    cut2 = F.floor(F.lit(0.85) * n).cast("bigint")

    def row(kind, key, value):
        return F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"),
                        F.lit(key).alias("key") if isinstance(key, str) else key.alias("key"), value.alias("n"))

    # one pass: the total row fans out into total/train/validation/test
    rows = F.when(
        F.col("_gid") == 3,
        F.array(row("total", "", n), row("train", "", cut1), row("validation", "", cut2 - cut1),
                row("test", "", n - cut2)),
    ).otherwise(
        F.array(row(F.when(F.col("_gid") == 1, "sources").otherwise("categories"),
                    F.when(F.col("_gid") == 1, F.col("source")).otherwise(F.col("category")), n))
    )
    return g.select(F.explode(rows).alias("r")).select("r.*")


def split_sizes_of(total: DataFrame) -> DataFrame:
    """``kind, key, n``: the total (one row, ``n``) and the sizes of its exact split."""
    n = F.col("n").cast("bigint")
    cut1, cut2 = (F.floor(F.lit(x) * n).cast("bigint") for x in (0.7, 0.85))
    sizes = {"total": n, "train": cut1, "validation": cut2 - cut1, "test": n - cut2}
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit("").alias("key"), v.alias("n")) for k, v in sizes.items()])
    return total.select(F.explode(rows).alias("r")).select("r.*")


def reject_counts(reasons: DataFrame) -> DataFrame:
    """Rows per reject reason (``kept`` included)."""
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
