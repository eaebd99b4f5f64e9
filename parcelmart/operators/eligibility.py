"""Which orders count, and in which week."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.dates import quarter_of, week_keys, whole_week_ranges
from parcelmart.functions.text import cancel_keyword, clean_text, final_status
from parcelmart.operators.normalize import backfill_columns
from parcelmart.schemas import STATUS_FINAL


def eligibility_flags(orders: DataFrame) -> DataFrame:
    """Adds is_cancelled, is_final_status and eligible_shipment_flag (0/1)."""
    flags = backfill_columns(orders).withColumns(
        {
            "is_cancelled": cancel_keyword(
                F.col("delivery_status"),
                F.col("return_reason"),
                F.col("failed_reason"),
                F.col("delay_reason"),
            ),
            "is_final_status": final_status(F.col("delivery_status")),
        }
    )
    eligible = (F.col("is_cancelled") == 0) & (F.col("is_final_status") == 1)
    return flags.withColumn("eligible_shipment_flag", eligible.cast("int"))


def eligible_orders(flagged: DataFrame) -> DataFrame:
    """The denominator of every rate: final shipments that were not cancelled."""
    return flagged.filter(F.col("eligible_shipment_flag") == 1)


def eligible_exports(exports: DataFrame) -> DataFrame:
    """The same choice on raw export rows, before anything is parsed.

    The reason that the normaliser gives an export row is one of its own texts or comes
    with a cancel word in them, so status, failed and delay reason decide alone. The
    filter reads three raw columns and reaches the scan."""

    def text(name: str) -> Column:
        return clean_text(F.col(name), "", strict=True)

    status = text("delivery_status")
    cancelled = cancel_keyword(status, text("failed_reason"), text("delay_reason"))
    return exports.filter(F.lower(status).isin(STATUS_FINAL) & (cancelled == 0))


def add_week_keys(orders: DataFrame, iso_year: bool = False) -> DataFrame:
    return orders.withColumns(week_keys(F.col("event_date"), iso_year))


def _between(date: Column, start: dt.date, end: dt.date) -> Column:
    # Half-open against the bare column, so that it reaches the file scan for both
    # date and timestamp columns.
    return (date >= F.lit(start)) & (date < F.lit(end + dt.timedelta(days=1)))


def quarter_filter(
    orders: DataFrame, today: dt.date, date: str = "event_date", undated: bool = False
) -> DataFrame:
    """Orders of the quarter that holds ``today``, and on request those without a date."""
    condition = _between(F.col(date), *quarter_of(today))
    return orders.filter(condition | F.col(date).isNull() if undated else condition)


def load_window(
    orders: DataFrame,
    today: dt.date,
    date: str = "event_date",
    iso_year: bool = False,
    undated: bool = False,
) -> DataFrame:
    """Orders of the current quarter and the other days of every week it touches, so
    that each week handed to the marts is whole; on request also those without a date."""
    ranges = whole_week_ranges(*quarter_of(today), iso_year)
    condition = F.col(date).isNull() if undated else F.lit(False)
    for start, end in ranges:
        condition = condition | _between(F.col(date), start, end)
    return orders.filter(condition)


def latest_per_order(orders: DataFrame, order_by: str = "created_at") -> DataFrame:
    """Optional: one row per order id, the newest. Off by default, repeated orders
    count as often as they come. The maximum is taken before the shuffle as well."""
    others = [c for c in orders.columns if c != "order_id"]
    newest = F.max(F.struct(F.col(order_by).alias("_by"), *others)).alias("newest")
    return (
        orders.groupBy("order_id")
        .agg(newest)
        .select("order_id", *[F.col(f"newest.{c}") for c in others])
        .select(*orders.columns)
    )
