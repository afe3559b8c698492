"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Every stage takes the table its predecessor kept and returns a table with the
columns of ``documents`` (the last one: the packed pieces).  ``run`` writes
each stage's result as Parquet under the shared checkpoint folder and hands
the reread table on, so a lost executor costs a stage at most.

All stages pass extra columns on, whatever their names, and give an empty table
for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import lines, mixing, near, packing, quality
from corpusforge.operators.plan_utils import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null and empty texts too; repeated rows are judged alike."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller doc_id holds go; every document stays, with its remaining text.

    A null text becomes the empty one; rows with the same doc_id are one document, rows without doc_id one after all others.
    """
    out = lines.dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays.

    Equal texts are copies, null and empty ones too; of rows that repeat doc_id and text one stays; rows without doc_id all stay.
    """
    return near.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as their source's target weight asks; a null source is a source, a null text has no words."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences; a null text is the end id alone."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: The near-dedup and packing stages are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
