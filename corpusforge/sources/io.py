"""Scans and sinks.

Raw articles arrive as one small pretty-printed JSON object per file.  Small
files cannot be split and cost a task-open each, so the intended use is to
scan them once (``scan_raw_json``) and compact to Parquet (``compact_raw``);
every later job reads the Parquet copy with pruning and pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.sources import raw_files, schemas

SCAN_TASKS = 200  # tasks of a scan of small files, at most, or eight for each core


# ---------------------------------------------------------------------------
# S3: Parquet tables
# ---------------------------------------------------------------------------
def read_table(spark: SparkSession, path: str) -> DataFrame:
    """S3: a Parquet table, a file or a folder of files (pushdown and pruning apply)."""
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# Directory of JSON objects, one per file
# ---------------------------------------------------------------------------
def scan_raw_json(spark: SparkSession, path: str, exact_keys: bool = True, pattern: str = "*.json") -> DataFrame:
    """Read every file named like ``pattern`` under ``path`` as one raw article.

    ``exact_keys=True`` reads each file whole and parses it with ``from_json``,
    adding ``_keys`` (the object's keys) so a missing key and a JSON ``null``
    stay distinguishable, plus ``_file``.  Unparseable files are dropped (P3).
    ``exact_keys=False`` uses the multi-line JSON reader with
    ``_corrupt_record`` (same rows; no key list).

    A folder that :func:`raw_files.save` wrote is read by its manifests: each
    task lists and reads the folder of one writer, the driver lists no file.
    """
    if not exact_keys:
        df = (
            spark.read.schema(schemas.RAW_WITH_CORRUPT)
            .option("multiLine", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("pathGlobFilter", pattern)
            .json(path)
        )
        df = df.withColumn("_file", F.input_file_name())
        return df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return _parsed_files(spark, path, pattern).filter("reason IS NULL").drop("reason", "value")


def _whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``value, _file``: the content of every file.

    Spark counts 4 MB for opening a file, so a task would read some 30 small ones; they are put together.
    """
    if path_exists(spark, f"{path.rstrip('/')}/{raw_files.MANIFESTS}"):
        return raw_files.scan(spark, path, pattern=pattern).select("value", F.col("file").alias("_file"))
    text = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True).withColumn("_file", F.input_file_name())
    return text.coalesce(max(SCAN_TASKS, 8 * spark.sparkContext.defaultParallelism))


def _parsed_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Every file as a raw article with ``_keys, _file``, its content ``value``, and the ``reason`` why it is none (null if it is one)."""
    text = _whole_files(spark, path, pattern)
    v = F.try_parse_json("value")
    kinds = [F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant")) for f in schemas.TEXT_FIELDS]
    parsed = text.select(
        F.from_json("value", schemas.RAW).alias("r"),
        F.json_object_keys("value").alias("_keys"),
        *[k.alias(f"_t{i}") for i, k in enumerate(kinds)],
        "_file", "value", v.isNotNull().alias("_json"),
    )
    # from_json yields null for a malformed document; json_object_keys yields
    # null for anything that is not a JSON object.  A list, object or number
    # where a text is cleaned makes the whole row unusable.
    reason = F.when(~F.col("_json"), "not JSON").when(F.col("r").isNull() | F.col("_keys").isNull(), "not an object")
    for i, f in enumerate(schemas.TEXT_FIELDS):
        reason = reason.when(~F.coalesce(F.col(f"_t{i}").isin("STRING", "VOID"), F.lit(True)), f"{f} is no text")
    return parsed.select("r.*", "_keys", "_file", "value", reason.alias("reason"))


def sort_raw_json(spark: SparkSession, path: str, out: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """P3 with a dead-letter table: one pass over the files writes raw articles and refused records apart, under ``out``.

    Returns the articles (as :func:`scan_raw_json` gives them) and the refused
    records: ``_file, reason, value`` (what the file holds).  Each file is in
    exactly one of the two; both are read back from what was written.
    """
    rows = _parsed_files(spark, path, pattern)
    rows = rows.withColumns({"value": F.when(F.col("reason").isNotNull(), F.col("value")), "refused": F.col("reason").isNotNull()})
    rows.write.mode("overwrite").partitionBy("refused").parquet(out)
    back = spark.read.schema(rows.schema).parquet(out)
    return back.filter("NOT refused").drop("reason", "value", "refused"), back.filter("refused").select("_file", "reason", "value")


def compact_raw(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a raw scan as Parquet partitioned by source (one-time compaction)."""
    df.drop("_file").write.mode(mode).partitionBy("source").parquet(path)


# ---------------------------------------------------------------------------
# CSV corpora
# ---------------------------------------------------------------------------
def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def finished(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers k, ascending, of the folders ``path/name=k`` that were written to their end."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(x[len(name) + 1:]) for x in names if x.startswith(f"{name}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{x}/_SUCCESS")))


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_first_existing(spark: SparkSession, paths, schema=None) -> DataFrame | None:
    """The first existing corpus wins (e.g. tokenised before processed)."""
    for p in paths:
        if path_exists(spark, p):
            return read_csv(spark, p, schema)
    return None


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------
def write_raw(df: DataFrame, path: str, fmt: str = "json", mode: str = "append", rows_per_file: int = 100_000, salts: int = 16) -> None:
    """K1: raw articles partitioned by source/category (not one file per row).

    Rows meet by their folder first, so a folder gets at most ``salts`` tasks'
    files instead of one from every task; the salt keeps a site with a third
    of all rows from landing in one task.
    """
    salt = F.pmod(F.xxhash64("url"), F.lit(salts))
    (df.repartition("source", "category", salt).write.mode(mode).partitionBy("source", "category")
     .option("maxRecordsPerFile", rows_per_file).format(fmt).save(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2/K4: header, UTF-8, inner quotes doubled."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_links_csv(df: DataFrame, path: str) -> None:
    """K3: ``url, source, category`` with a header on every write."""
    write_csv(df.select("url", "source", "category"), path)


def write_splits(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """K5: all three splits in one job, ``split=train|validation|test`` folders."""
    w = df.write.mode(mode).partitionBy("split")
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    w.format(fmt).save(path)


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K6: the statistics as JSON lines ``kind, key, n`` (one per site and
    category: their number grows with the crawl, so they are never one row)."""
    stats.write.mode(mode).json(path)


def is_done(spark: SparkSession, path: str) -> bool:
    """K7: whether a job finished writing ``path`` (a failed one leaves the folder without this mark)."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")
