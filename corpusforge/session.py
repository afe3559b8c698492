"""Session helpers.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset, so cluster-wide choices (shuffle partitions,
checkpoint dir, ...) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings we want on every session unless the cluster already chose a value:
# (key, Spark's built-in default, ours).  A value other than the built-in
# default was chosen by the platform and is left alone.
DEFAULTS = (
    ("spark.sql.adaptive.enabled", "true", "true"),
    ("spark.sql.adaptive.coalescePartitions.enabled", "true", "true"),
    ("spark.sql.adaptive.skewJoin.enabled", "true", "true"),
    # Pandas UDFs here take whole pages / texts per row: keep Arrow batches
    # small enough for the Python worker's memory.
    ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
)


def configure(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for key, builtin, ours in DEFAULTS:
        try:
            if conf.get(key, None) in (None, "", builtin):
                conf.set(key, ours)
        except Exception:  # static conf on a running cluster: leave it
            pass
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()
_SCRATCH: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusforge`` importable in Python workers (pandas UDFs).

    Zips the package once per SparkContext and registers it with
    ``addPyFile``; Spark copies it to every executor.  A no-op when the
    package is already installed on the cluster's Python path.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED or spark.conf.get("corpusforge.shipped", "false") == "true":
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="corpusforge-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "corpusforge"), "zip", os.path.dirname(pkg_dir), "corpusforge")
    sc.addPyFile(archive)
    spark.conf.set("corpusforge.shipped", "true")
    _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """This application's folder under the shared one named by ``spark.checkpoint.dir``.

    Executors must see it too, so a session without the setting is refused
    unless everything runs in one process (local mode), where a temporary
    folder serves.  What lies there are intermediates: the folder goes when
    the driver's JVM ends.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="corpusforge-ckpt-")
            spark.conf.set("spark.checkpoint.dir", d)
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    if sc.applicationId not in _SCRATCH:
        path = sc._jvm.org.apache.hadoop.fs.Path(d)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
        _SCRATCH.add(sc.applicationId)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder (for written intermediates)."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "corpusforge") -> SparkSession:
    """Local session used by tests, the bench and the examples."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
