"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


# Setting: (Spark's default, ours).
TUNING = {
    # The normalisers compute many text columns in one step. Fused into one Java method they
    # exceed the size up to which the JVM compiles methods; below this limit Spark splits
    # them instead, which ran the same projection in two thirds of the time.
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    # The format audit takes up to 4,096 lines of a file, by their rank: up to this rank Spark
    # drops the others before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": ("1000", "4096"),
    # Payloads are read back whole, so a VARIANT that is shredded into columns is only put
    # together again: written as one column it took half the time.
    "spark.sql.variant.inferShreddingSchema": ("true", "false"),
    # Landed and staged rows lie on disk until they are read back.
    "spark.sql.parquet.compression.codec": ("snappy", "zstd"),
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> None:
    """Session settings that suit this package's plans, where the session has defaults."""
    for key, (default, value) in TUNING.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write go as soon as it has ended, as nothing reads them any more, and not
    whenever the driver collects its plan."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. Settings that can only be made at its
    start, such as ``spark.checkpoint.dir``, go into ``extra``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("parcelmart")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, which the cluster or the
    session's builder sets, else the warehouse. A warehouse on the machine's own disk is refused
    unless the session runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if urlsplit(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{warehouse}/scratch"
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The folder of this session's intermediate tables."""
    return f"{shared_folder(spark)}/parcelmart/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one intermediate table."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system it is."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this session. Call it when none of the DataFrames that
    the registered queries gave is needed any more."""
    drop_path(spark, run_folder(spark))
