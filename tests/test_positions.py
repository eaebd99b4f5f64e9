"""Row numbers of sorted tables."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parcelmart.operators.positions import numbered


@pytest.mark.parametrize("groups", [[], ["city"], ["city", "kind"]])
def test_numbers_are_those_of_a_sort(spark, groups):
    rows = [(k, ["A", "B", None][k % 3 % 2 + k % 2], k % 2, [None, 1, 5, 5][k % 4], "x") for k in range(500)]
    rows += [(500 + k, "A", 0, 5, "x") for k in range(500)]  # half of the rows have one key
    df = spark.createDataFrame(rows, "id long, city string, kind int, value int, position string").repartition(5)
    got = numbered(df, groups, [F.desc_nulls_last("value"), F.col("id")], "number")
    assert got.columns == [*df.columns, "number"]
    want = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[3] is None, -(r[3] or 0), r[0])):
        want[tuple(row[df.columns.index(g)] for g in groups)].append(row[0])
    numbers = {i: n for ids in want.values() for n, i in enumerate(ids)}
    assert {r.id: r.number for r in got.collect()} == numbers


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, city string")
    assert numbered(df, ["city"], [F.col("id")]).collect() == []


def test_no_window_holds_a_group(spark):
    """The only windows run over a row per file and group."""
    df = spark.range(1000).withColumn("g", F.lit(1))
    plan = numbered(df, ["g"], [F.col("id")])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "Aggregate" in window and "row_number" not in plan


def test_numbers_of_a_whole_table_do_not_shuffle_its_rows_again(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("value"))
    got = numbered(df, [], [F.col("value"), F.col("id")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r.id for r in got.orderBy("position").collect()] == sorted(range(100), key=lambda i: (i % 7, i))
