"""Row numbers of a sorted table, without a window over its rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.session import scratch_path

FILE, AT = "file of the sorted table", "row of the file"


def numbered(df: DataFrame, groups: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with the number of each row, from 0, in the order of its group; without ``groups`` in the
    order of the whole table.

    The rows are sorted by ranges and written. A row's number is its place in its file plus the rows of
    its group in earlier files, so no task holds a group, and only a row per file and group is
    summed. ``order`` should end in a column that tells all rows apart: then a run of equal keys can be
    cut between ranges, and the numbers do not depend on the run. ``df`` is read twice, by the sampling
    of the ranges and by the sort."""
    keys = [*[F.col(g) for g in groups], *order]
    path = scratch_path(df.sparkSession, "sorted")
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(AT))
    parts = rows.groupBy(FILE, *groups).agg(F.min(AT).alias("first"), F.count("*").alias("n"))
    # Spark names files by the number of the range.
    range_number = F.regexp_extract(FILE, r"^part-(\d+)", 1).cast("long")
    earlier = Window.partitionBy(*groups).orderBy(range_number, FILE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    offsets = parts.select(F.col(FILE), *groups, before.alias("offset"))
    same = [F.col(f"r.`{FILE}`") == F.col(f"o.`{FILE}`")]
    same += [F.col(f"r.`{g}`").eqNullSafe(F.col(f"o.`{g}`")) for g in groups]
    number = (F.col(f"r.`{AT}`") + F.col("o.offset")).cast("long").alias(name)
    if not groups:  # a row per file
        offsets = F.broadcast(offsets)
    joined = rows.alias("r").join(offsets.alias("o"), reduce(and_, same))
    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], number)
