"""Loads as readers see them, the order index, counts taken while writing, and retention."""

import shutil
import time

import pytest
from pyspark.sql import functions as F
from test_tables import D1, D2, orders_frame, weekly

from parcelmart.operators import tables
from parcelmart.plans import loads
from parcelmart.plans.loads import (
    Layout,
    check_marts,
    compact_staging,
    live_orders,
    load_orders,
    read_base,
    read_marts,
    vacuum_layout,
)
from parcelmart.schemas import MARTS


def shipments(spark, layout):
    return {name: sum(r.total_shipments for r in mart.collect()) for name, mart in read_marts(spark, layout).items()}


def clean(spark, layout):
    return [tuple(r) for r in check_marts(spark, layout).collect() if r.violations]


@pytest.mark.parametrize("dies_at", ["weekly_base", *MARTS, "loads"])
def test_a_load_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch, dies_at):
    layout = Layout(str(tmp_path / "w"))
    assert shipments(spark, layout) == dict.fromkeys(MARTS, 0)
    load_orders(spark, layout, orders_frame(spark, (1, D1, "A", "Delivered"), (2, D1, "A", "Lost")), token="a")
    assert shipments(spark, layout) == dict.fromkeys(MARTS, 2)
    write, record = tables.upsert_mart, loads._record

    def upsert(batch, path, *args, **options):
        write(batch, path, *args, **options)
        if path.endswith(dies_at):
            raise OSError("died after its commit")

    def no_record(*args, **options):
        raise OSError("died before its record")

    for module in (tables, loads):
        monkeypatch.setattr(module, "upsert_mart", upsert)
    if dies_at == "loads":
        monkeypatch.setattr(loads, "_record", no_record)
    more = orders_frame(spark, (3, D1, "A", "Delivered"), (2, D2, "A", "Lost"))
    with pytest.raises(OSError, match="died"):
        load_orders(spark, layout, more, token="b")
    monkeypatch.undo()
    assert shipments(spark, layout) == dict.fromkeys(MARTS, 2) and clean(spark, layout) == []
    assert live_orders(spark, layout).count() == 2
    vacuum_layout(spark, layout)  # keeps what readers see
    assert shipments(spark, layout) == dict.fromkeys(MARTS, 2)
    if dies_at == "fact_return_reason_weekly":
        # another load takes the number, and touches fewer weeks than the one that died
        load_orders(spark, layout, orders_frame(spark), token="c")
        assert weekly(spark, layout) == [(2026, 6, "A", 2, 20.0)] and clean(spark, layout) == []
    load_orders(spark, layout, more, token="b")
    assert shipments(spark, layout) == dict.fromkeys(MARTS, 3) and clean(spark, layout) == []
    assert weekly(spark, layout) == [(2026, 10, "A", 1, 10.0), (2026, 6, "A", 2, 20.0)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_neither_shuffled_nor_read_whole(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"), buckets=16)
    for k in range(2):
        load_orders(spark, layout, orders_frame(spark, *[(i, D1, "A", "Delivered") for i in range(k, 40 + k)]))
    ids = loads._bucketed_orders(spark, layout, [2], 16).select("order_id").distinct()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        every = live_orders(spark, layout, ids)
        few = live_orders(spark, layout, ids.filter("order_id in ('o1', 'o2')"))
        joined = loads._bucketed_orders(spark, layout, [1, 2], 16).join(ids, "order_id", "left_semi")
        assert "Exchange" not in plan(every) and "Exchange" not in plan(few) and "Exchange" not in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert every.count() == 40 and few.count() == 2
    assert "SelectedBucketsCount: 16 out of 16" in plan(joined)
    assert "SelectedBucketsCount: 2 out of 16" in plan(few)
    assert spark.sql("SHOW TABLES LIKE 'parcelmart_*'").count() == 0


def test_the_time_of_a_load_does_not_grow_with_the_loads(spark, tmp_path):
    layout, times = Layout(str(tmp_path / "w"), buckets=4), []
    for k in range(10):
        rows = orders_frame(spark, *[(i, D1, "A", "Delivered") for i in range(10 * k, 10 * k + 15)])
        start = time.perf_counter()
        load_orders(spark, layout, rows)
        times.append(time.perf_counter() - start)
    assert shipments(spark, layout) == dict.fromkeys(MARTS, 105) and clean(spark, layout) == []
    assert sorted(times[7:])[1] < 1.6 * sorted(times[1:4])[1], times


def test_checks_read_counts_and_find_a_damaged_week(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"))
    load_orders(spark, layout, orders_frame(spark, (1, D1, "A", "Delivered"), (2, D2, "A", "Lost"), (3, None, "A", "Lost"), (4, D1, "B", "Cancelled")))
    load_orders(spark, layout, orders_frame(spark, (1, D1, "B", "Lost"), (5, D1, "A", "Lost")))
    load_orders(spark, layout, orders_frame(spark, (6, D2, "A", "Lost")), replaced=[(2026, 10), (2026, 30)])
    shutil.rmtree(layout.staging)  # no staged order is needed for the checks
    assert clean(spark, layout) == []
    assert {r.check_name for r in check_marts(spark, layout).collect()} >= {"week_total_is_loaded", "eligible_is_based", "amounts_out_of_range"}
    shutil.rmtree(f"{layout.mart('fact_return_reason_weekly')}/data/version=2/year=2026/week_of_year=6")
    (tmp_path / "w/mart/fact_return_reason_weekly/data/version=2/year=2026/week_of_year=6").mkdir()
    assert ("fact_return_reason_weekly", "week_total_is_loaded", 1) in clean(spark, layout)


def test_amounts_that_do_not_fit_are_counted_in_the_base(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"))
    rows = orders_frame(spark, (1, D1, "A", "Delivered"), (2, D1, "A", "Delivered"))
    load_orders(spark, layout, rows.withColumn("cod_value", F.lit(None).cast("decimal(28,6)")))
    assert clean(spark, layout) == [("staging", "amounts_out_of_range", 2)]
    load_orders(spark, layout, rows.filter("order_id = 'o1'"))
    assert clean(spark, layout) == [("staging", "amounts_out_of_range", 1)]


def size(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_compaction_keeps_what_counts(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"), buckets=4)
    assert compact_staging(spark, layout) is None
    same = [(i, D1, "A", "Delivered") for i in range(300)]
    nameless = orders_frame(spark, (1, D1, "N", "Lost")).withColumn("order_id", F.lit("No Value"))
    for k in range(3):
        load_orders(spark, layout, orders_frame(spark, *same[k:]).unionByName(nameless))
    load_orders(spark, layout, orders_frame(spark, (999, D2, "A", "Lost")), replaced=[(2026, 10)])

    def seen():
        live = sorted(map(str, live_orders(spark, layout).drop("load").collect()))
        return live, weekly(spark, layout), sorted(map(str, read_base(spark, layout).collect()))

    before, bytes_before = seen(), size(tmp_path / "w/staging/orders")
    number = compact_staging(spark, layout)
    assert number == 5 and seen() == before and clean(spark, layout) == []
    gone = vacuum_layout(spark, layout)
    assert f"{layout.staging}/load=1" in gone and f"{layout.staging}/load=5" not in gone
    assert seen() == before and size(tmp_path / "w/staging/orders") < 0.6 * bytes_before
    # later loads replace rows of compacted orders and weeks
    load_orders(spark, layout, orders_frame(spark, (5, D2, "A", "Lost")), token="x")
    assert weekly(spark, layout) == [(2026, 10, "A", 2, 20.0), (2026, 6, "A", 299, 2990.0), (2026, 6, "N", 3, 30.0)]
    load_orders(spark, layout, orders_frame(spark, (7, D1, "A", "Lost")), replaced=[(2026, 6)])
    assert weekly(spark, layout) == [(2026, 10, "A", 2, 20.0), (2026, 6, "A", 1, 10.0)] and clean(spark, layout) == []
