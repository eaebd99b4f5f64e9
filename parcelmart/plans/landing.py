"""Normalised orders as they land, in folders by month, so that a weekly run opens only its window.

    <root>/landed/batch=20260105/event_month=202601/*.parquet
    <root>/landed/batch=20260105/event_month=__HIVE_DEFAULT_PARTITION__/*.parquet  orders without a date
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.functions.dates import quarter_of, whole_week_ranges
from parcelmart.operators.eligibility import load_window, quarter_filter
from parcelmart.operators.packing import pack_texts, unpack_texts
from parcelmart.plans.build import run_quarter
from parcelmart.plans.loads import Layout, identified
from parcelmart.session import list_folders, tidy

FOLDERS = T.StructType([T.StructField("batch", T.LongType()), T.StructField("event_month", T.IntegerType())])


def _month(date: Column) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("int")


def land_orders(orders: DataFrame, layout: Layout, batch: int) -> None:
    """Keep normalised orders (``export_normalize`` or another) by the month of their date. A batch that
    lands again replaces itself; batches are numbered in the order in which they land."""
    rows = orders.withColumn("event_month", _month(F.col("event_date")))
    moved = unpack_texts(pack_texts(rows).hint("rebalance", "event_month"), rows.schema)
    with tidy(orders.sparkSession):
        moved.write.mode("overwrite").partitionBy("event_month").parquet(f"{layout.landed}/batch={batch}")


def landed_batches(spark: SparkSession, layout: Layout) -> list[int]:
    names = list_folders(spark, layout.landed)
    return sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))


def landed_window(
    spark: SparkSession, layout: Layout, schema: T.StructType, today: dt.date, *, whole_weeks: bool = True, iso_year: bool = False
) -> DataFrame:
    """The landed orders of the quarter that holds ``today``, with the other days of the weeks it touches
    unless ``whole_weeks`` is off, and those without a date. Only the folders of these months are opened.

    Of an order that the window holds from several batches the rows of the last one count; rows of one batch
    count as often as they come, and rows without an id always. An order that a later batch has moved out of
    the window still stands in it as it landed before: only the window is read."""
    batches = landed_batches(spark, layout)
    if not batches:
        return spark.createDataFrame([], schema)
    ranges = whole_week_ranges(*quarter_of(today), iso_year) if whole_weeks else [quarter_of(today)]
    days = {start + dt.timedelta(days=k) for start, end in ranges for k in range((end - start).days + 1)}
    months = sorted({day.year * 100 + day.month for day in days})
    rows = spark.read.schema(T.StructType(schema.fields + FOLDERS.fields)).parquet(layout.landed)
    rows = rows.filter(F.col("event_month").isin(months) | F.col("event_month").isNull())
    if whole_weeks:
        rows = load_window(rows, today, iso_year=iso_year, undated=True)
    else:
        rows = quarter_filter(rows, today, undated=True)
    if len(batches) > 1:
        named = rows.filter(identified())
        last = named.groupBy("order_id").agg(F.max("batch").alias("last_batch"))
        newest = named.join(last, "order_id").filter("batch = last_batch")
        rows = newest.select(*rows.columns).unionByName(rows.filter(~identified()))
    return rows.select(*schema.names)


def run_landed_quarter(
    spark: SparkSession, layout: Layout, schema: T.StructType, today: dt.date, *, whole_weeks: bool = True, iso_year: bool = False, **options
) -> None:
    """The weekly run over the landed orders: ``run_quarter`` of their window."""
    window = landed_window(spark, layout, schema, today, whole_weeks=whole_weeks, iso_year=iso_year)
    run_quarter(spark, layout, window, today, whole_weeks=whole_weeks, iso_year=iso_year, **options)
