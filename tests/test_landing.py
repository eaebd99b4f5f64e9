"""Landed orders by month, and weekly runs over them."""

import datetime as dt

from pyspark.sql import functions as F
from test_tables import D1, D2, orders_frame, weekly

from parcelmart.plans.landing import land_orders, landed_window, run_landed_quarter
from parcelmart.plans.loads import Layout, check_marts

OLD, NEXT = dt.date(2025, 6, 3), dt.date(2026, 4, 4)  # a year before; a day of a week that the quarter's edge cuts


def ids(df):
    return sorted((r.order_id, str(r.event_date), r.city) for r in df.collect())


def test_a_window_opens_its_months_only(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"))
    first = orders_frame(spark, (1, D1, "A", "Lost"), (1, D1, "A", "Lost"), (2, OLD, "A", "Lost"), (3, None, "A", "Lost"), (4, NEXT, "A", "Lost"), (5, D2, "A", "Lost"))
    assert landed_window(spark, layout, first.schema, D1).count() == 0
    nameless = orders_frame(spark, (1, D1, "N", "Lost")).withColumn("order_id", F.lit("No Value"))
    for _ in range(2):  # a batch that lands again replaces itself
        land_orders(first.unionByName(nameless), layout, 1)
    window = landed_window(spark, layout, first.schema, D1)
    assert window.columns == first.columns
    assert [r[0] for r in ids(window)] == ["No Value", "o1", "o1", "o3", "o4", "o5"]
    bare = landed_window(spark, layout, first.schema, D1, whole_weeks=False)
    assert [r[0] for r in ids(bare)] == ["No Value", "o1", "o1", "o3", "o5"]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "event_month#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert sum("event_month=202506" in f for f in window.inputFiles()) <= 1  # listed, not opened:
    read = window.select(F.col("event_date")).filter("event_date < '2026-01-01'")
    assert read.count() == 0
    # a later batch replaces its orders within the window
    land_orders(orders_frame(spark, (1, D2, "B", "Lost")).unionByName(nameless), layout, 2)
    got = ids(landed_window(spark, layout, first.schema, D1))
    assert [r for r in got if r[0] == "o1"] == [("o1", str(D2), "B")] and [r[0] for r in got].count("No Value") == 2


def test_weekly_runs_over_landed_orders(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"))
    first = orders_frame(spark, (1, D1, "A", "Delivered"), (2, OLD, "A", "Lost"), (3, None, "A", "Lost"))
    land_orders(first, layout, 1)
    for _ in range(2):
        run_landed_quarter(spark, layout, first.schema, D1)
        assert weekly(spark, layout) == [(2026, 6, "A", 1, 10.0), (None, None, "A", 1, 10.0)]
    land_orders(orders_frame(spark, (1, D1, "B", "Returned")), layout, 2)
    run_landed_quarter(spark, layout, first.schema, D2)
    assert weekly(spark, layout) == [(2026, 6, "B", 1, 10.0), (None, None, "A", 1, 10.0)]
    assert all(r.violations == 0 for r in check_marts(spark, layout).collect())
