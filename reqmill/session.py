"""Session settings the library is tuned for, and the shared scratch folder."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Applied only where the session does not already say otherwise. Results do not
# depend on any of them: zone-free timestamps and explicit schemas see to that.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join that feeds an aggregate on the same key is left skewed otherwise.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods over 8000 bytes. Staging's 23 casts in one
    # generated method ran at a third of the speed; above the limit Spark splits it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# For requests. A line of some 45 bytes in a file is a row of 400 in the sort that comes
# before rows fold by request. A split of 128 MB is then more than a task's memory on
# executors of 4 cores and 10 GB, so that each row was spilled; this one is a quarter.
WIDE_ROWS = {"spark.sql.files.maxPartitionBytes": "32m"}


def apply_defaults(spark: SparkSession, more: Mapping[str, str] | None = None) -> SparkSession:
    explicit = spark.conf.getAll
    explicit = explicit() if callable(explicit) else explicit
    for key, value in {**DEFAULTS, **(more or {})}.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: str = "*", **conf: str) -> SparkSession:
    """A single-node session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach, deleted when the session ends.

    It lies under spark.checkpoint.dir. Where that is not set, as in tests, it lies under
    the warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = f"{root.rstrip('/')}/reqmill-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def drop_dir(spark: SparkSession, folder: str) -> None:
    """Delete a shared_dir() before the session ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_reqmill_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='reqmill-')}/reqmill", "zip", package.parent, package.name)
    sc.addPyFile(archive)
    sc._reqmill_shipped = True
