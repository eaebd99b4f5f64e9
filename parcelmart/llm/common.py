"""Small helpers that the operators share."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from parcelmart.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder, so that a lost executor costs no
    recomputation and each step is planned from files. The step's shuffle files go when the table is
    there: nothing reads them any more."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches of few rows where the session has Spark's default, since rows
    may hold very long texts."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df.mapInArrow(function, schema)


def release(spark: SparkSession) -> None:
    """Let the driver give back what earlier steps planned with. Each step leaves plans, closures and
    broadcasts behind as garbage, which a driver heap takes in up to its limit before it collects any, and
    Spark's cleaner drops the broadcasts and shuffle files of a step only when it is collected."""
    gc.collect()  # references that Python holds to plans
    spark.sparkContext._jvm.System.gc()
