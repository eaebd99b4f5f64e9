"""What the plans must look like."""

import datetime as dt

from parcelmart.operators.eligibility import load_window, quarter_filter
from parcelmart.plans import mart_queries
from parcelmart.plans.shipments import shipments, table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_windows_reach_the_scan(spark):
    orders = table(spark, SF, "orders").select("o_orderkey", "o_orderdate")
    for df in (
        quarter_filter(orders, dt.date(1997, 5, 15), "o_orderdate"),
        load_window(orders, dt.date(1997, 2, 15), "o_orderdate"),
    ):
        text = plan(df)
        assert "GreaterThanOrEqual(o_orderdate" in text.split("PushedFilters")[1]
        assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_only_needed_tables_are_read(spark):
    text = plan(shipments(spark, SF, ["tracking_no", "failed_reason"]))
    assert "lineitem.parquet" in text and "orders.parquet" not in text
    assert "l_shipdate" not in text


def test_flagship_shuffles_orders_once_after_the_joins(spark):
    text = plan(mart_queries.fact_returns_weekly(spark, SF)).split("Initial Plan")[-1]
    assert "partial_sum" in text and "Window" not in text and "Python" not in text
    # Exports that do not count are dropped no later than the join that completes their status.
    assert "delivered" in text.split("part.parquet")[0].split("SortMergeJoin")[1]
