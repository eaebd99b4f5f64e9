"""Tables bucketed by a key: rows of one key value lie in one file, so joins on it need no shuffle."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from parcelmart.session import drop_path, scratch_path


@dataclass(frozen=True)
class Bucketed:
    """A bucketed scratch table, known to the session's catalog until it is dropped."""

    spark: SparkSession
    name: str
    path: str

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Out of the catalog; the files stay for the plans that were made of ``rows``."""
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")

    def drop(self) -> None:
        self.forget()
        drop_path(self.spark, self.path)


def write_buckets(df: DataFrame, key: str, buckets: int, name: str, *, shuffle: bool = True) -> Bucketed:
    """``df`` as a scratch table of ``buckets`` buckets by ``key``, under a name that no other table has.
    ``shuffle=False`` for rows that come from a table of as many buckets by the same key: each task then
    holds rows of few buckets as it is."""
    spark = df.sparkSession
    table = Bucketed(spark, f"parcelmart_{name}_{uuid.uuid4().hex}", scratch_path(spark, name))
    rows = df.repartition(buckets, key) if shuffle else df
    rows.write.format("parquet").option("path", table.path).bucketBy(buckets, key).sortBy(key).saveAsTable(table.name)
    return table
