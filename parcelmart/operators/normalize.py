"""Order rows from every source, normalised to one typed shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.functions.dates import parse_ts_api, parse_ts_dayfirst
from parcelmart.functions.numbers import parse_money, parse_number, to_money
from parcelmart.functions.outcome import outcome_flag, outcome_reason, outcome_rule
from parcelmart.functions.text import (
    clean_text,
    cod_payment_role,
    cod_type,
    first_set,
    is_set,
    keyword_match,
    reason_code_text,
    region_text,
    service_bucket,
)
from parcelmart.schemas import (
    BACKFILLED_COLUMNS,
    COD,
    EXPORT_EXPEDITION,
    EXPORT_ORDER,
    NO_REASON,
    NO_VALUE,
    NON_COD,
    NOT_RETURN_WORDS,
    RETURN_WORDS,
    SOURCE_API1,
    SOURCE_API2,
    SOURCE_EXPORT,
)
from parcelmart.sources.payloads import API1_LOGISTIC

# Each normaliser works in stages (cleaned inputs, then decisions, then the row), so
# that an input used by many rules is computed once and not copied into each of them.


def api1_normalize(orders: DataFrame, order: str = "order") -> DataFrame:
    """Normalised rows of exploded API1 orders."""
    o = F.col(order)
    ship, to = o["shipment"], o["receiver"]["address_detail"]

    def non_empty(obj: Column) -> Column:
        return F.when(~obj.rlike(r"^\s*\{\s*\}\s*$"), obj)

    cleaned = orders.select(
        o.alias("o"),
        to.alias("to"),
        clean_text(first_set(ship["status_name"], o["status_name"])).alias("status"),
        F.from_json(
            F.coalesce(non_empty(o["logistic"]), non_empty(ship["logistic"])), API1_LOGISTIC
        ).alias("logistic"),
        F.coalesce(
            parse_ts_api(o["created_at"]),
            parse_ts_api(first_set(ship["pickup_time_date"], ship["pickup_time"])),
        ).alias("event_ts"),
        parse_number(F.coalesce(o["cod"], ship["cod"])).alias("cod"),
    )
    o, ship, to, logistic = (F.col(c) for c in ("o", "o.shipment", "to", "logistic"))
    status = F.col("status")
    # Bare return statuses that give no reason.
    bare = F.upper(status).isin("RETURN", "RETUR")
    decided = cleaned.withColumns(
        {
            "is_return": keyword_match(status, RETURN_WORDS, NOT_RETURN_WORDS),
            "reason": F.when(bare, F.lit(NO_REASON)).otherwise(status),
        }
    )
    is_return, cod = F.col("is_return"), F.col("cod")
    return decided.select(
        F.lit(SOURCE_API1).alias("source_system"),
        clean_text(first_set(o["awb_number"], o["shipment_order_no"])).alias("order_id"),
        F.col("event_ts").cast("date").alias("event_date"),
        clean_text(to["province"]).alias("province"),
        clean_text(to["city"]).alias("city"),
        clean_text(first_set(logistic["name"], ship["logistic_name"])).alias("expedition"),
        service_bucket(first_set(logistic["rate_name"], logistic["rate_type_name"])).alias(
            "service_type"
        ),
        clean_text(
            first_set(ship["payment_method"], o["payment_method"], ship["payment_method_rts"])
        ).alias("payment_method"),
        F.when(is_set(o["is_cod"]) | (cod > 0), F.lit(COD))
        .otherwise(F.lit(NON_COD))
        .alias("cod_type"),
        parse_money(first_set(ship["total_price"], ship["total"], o["total"])).alias("order_value"),
        to_money(cod).alias("cod_value"),
        parse_money(first_set(ship["fee"], ship["shipping_fee"])).alias("shipping_fee"),
        is_return.cast("int").alias("return_flag"),
        F.when(is_return, F.col("reason")).otherwise(F.lit(NO_REASON)).alias("return_reason"),
    )


def api2_normalize(orders: DataFrame, order: str = "order") -> DataFrame:
    """Normalised rows of exploded API2 orders. They carry no delivery status, so none
    of them is ever an eligible shipment."""
    o = F.col(order)
    tracking, finance = o["tracking_info"], o["finance_info"]
    returned = is_set(tracking["returning_start_time"]) | is_set(tracking["returned_time"])
    reason = reason_code_text(tracking["latest_tracking_reason"], tracking["reason_code"])
    paid = parse_number(first_set(finance["cod_service_fee"], o["cod_amount"]))
    return orders.select(
        F.lit(SOURCE_API2).alias("source_system"),
        clean_text(first_set(o["order_info"]["order_sn"], o["order_info"]["order_id"])).alias(
            "order_id"
        ),
        parse_ts_api(o["order_info"]["ctime"]).cast("date").alias("event_date"),
        clean_text(o["deliver_info"]["deliver_state"]).alias("province"),
        clean_text(o["deliver_info"]["deliver_city"]).alias("city"),
        clean_text(first_set(o["base_info"]["three_pl_name"], F.lit(EXPORT_EXPEDITION))).alias(
            "expedition"
        ),
        service_bucket(o["base_info"]["product_name"]).alias("service_type"),
        # Fixed value: the text for an unknown payment method.
        clean_text(
            first_set(o["fulfillment_info"]["payment_method_rts"], F.lit("unknown"))
        ).alias("payment_method"),
        F.when(paid > 0, F.lit(COD)).otherwise(F.lit(NON_COD)).alias("cod_type"),
        parse_money(
            first_set(
                finance["actual_shipping_fee"], finance["estimated_shipping_fee"], o["cod_amount"]
            )
        ).alias("order_value"),
        parse_money(first_set(o["cod_amount"], finance["cod_service_fee"])).alias("cod_value"),
        parse_money(finance["actual_shipping_fee"]).alias("shipping_fee"),
        returned.cast("int").alias("return_flag"),
        F.when(returned, reason).otherwise(F.lit(NO_REASON)).alias("return_reason"),
    )


def export_normalize(exports: DataFrame, expedition: str | None = None) -> DataFrame:
    """Normalised rows of an all-text export frame. ``expedition`` names a column to
    take the carrier from; exports of one carrier have none."""
    carrier = F.lit(EXPORT_EXPEDITION)
    if expedition is not None:
        carrier = clean_text(F.col(expedition), EXPORT_EXPEDITION)

    def text(name: str, fallback: str = "") -> Column:
        return clean_text(F.col(name), fallback, strict=True)

    cleaned = exports.select(
        text("tracking_no", NO_VALUE).alias("order_id"),
        text("customer_reference_no", NO_VALUE).alias("customer_reference_no"),
        text("recipient_region", NO_VALUE).alias("region"),
        carrier.alias("expedition"),
        text("original_pickup_option").alias("first_option"),
        text("actual_pickup_option", NO_VALUE).alias("actual_option"),
        cod_payment_role(F.col("payment_role"))[0].alias("payment_method"),
        "cod_collection_flag",
        parse_number(F.col("cod_amount")).alias("cod_amount"),
        parse_money(F.col("parcel_value")).alias("order_value"),
        parse_number(F.col("actual_shipping_fee")).alias("actual_fee"),
        parse_number(F.col("estimated_shipping_fee")).alias("estimated_fee"),
        text("returned_to_sender_at").alias("returned_text"),
        text("failed_reason").alias("failed_reason"),
        text("delay_reason").alias("delay_reason"),
        text("delivery_status").alias("status"),
        parse_ts_dayfirst(F.col("created_at")).alias("created_at"),
        parse_ts_dayfirst(F.col("returned_to_sender_at")).alias("returned_to_sender_at"),
    )
    failed, delay, status = F.col("failed_reason"), F.col("delay_reason"), F.col("status")
    decided = cleaned.withColumns(
        {
            "rule": outcome_rule(F.col("returned_text"), failed, delay, status),
            "first_part": region_text(F.col("region"), 1),
            "second_part": region_text(F.col("region"), 2),
        }
    )
    rule, first_option = F.col("rule"), F.col("first_option")
    return decided.select(
        F.lit(SOURCE_EXPORT).alias("source_system"),
        "order_id",
        F.col("created_at").cast("date").alias("event_date"),
        clean_text(F.col("first_part")).alias("province"),
        clean_text(F.col("second_part")).alias("city"),
        "expedition",
        F.when(first_option.isin("", NO_VALUE), F.col("actual_option"))
        .otherwise(first_option)
        .alias("service_type"),
        "payment_method",
        cod_type(F.col("cod_amount"), F.col("cod_collection_flag")).alias("cod_type"),
        "order_value",
        to_money(F.col("cod_amount")).alias("cod_value"),
        to_money(
            F.when(F.col("actual_fee") > 0, F.col("actual_fee")).otherwise(F.col("estimated_fee"))
        ).alias("shipping_fee"),
        outcome_flag(rule).alias("return_flag"),
        outcome_reason(rule, failed, delay, status).alias("return_reason"),
        "customer_reference_no",
        F.when(status == "", F.lit(NO_VALUE)).otherwise(status).alias("delivery_status"),
        "failed_reason",
        "delay_reason",
        "created_at",
        "returned_to_sender_at",
    )


def bucket_services(orders: DataFrame) -> DataFrame:
    """What the safety pass changes in rows that come straight from ``export_normalize``:
    these are typed and their texts are filled, only the services are raw."""
    return orders.withColumn("service_type", service_bucket(F.col("service_type")))


def order_safety_pass(orders: DataFrame) -> DataFrame:
    """Export orders, fresh or read back from an envelope as texts, brought to the
    declared types: numbers parsed, services bucketed, missing texts filled."""
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in orders.schema.fields}

    def money(name: str) -> Column:
        return parse_money(F.col(name)) if is_text[name] else F.col(name)

    flag = F.col("return_flag").try_cast("int")
    # Fallbacks per column.
    fallbacks = {
        "return_reason": NO_REASON,
        "province": NO_VALUE,
        "city": NO_VALUE,
        "payment_method": NO_VALUE,
        "cod_type": NON_COD,
        "expedition": EXPORT_EXPEDITION,
    }
    passed = orders.withColumns(
        {
            "return_flag": F.coalesce(flag, F.lit(0)),
            **{c: money(c) for c in ("order_value", "cod_value", "shipping_fee")},
            "service_type": service_bucket(F.col("service_type")),
            **{c: clean_text(F.col(c), fallback) for c, fallback in fallbacks.items()},
        }
    )
    typed = [
        F.col(f.name).try_cast(f.dataType) if is_text[f.name] else F.col(f.name).cast(f.dataType)
        for f in EXPORT_ORDER.fields
    ]
    return passed.select(*[c.alias(f.name) for c, f in zip(typed, EXPORT_ORDER.fields)])


def backfill_columns(orders: DataFrame) -> DataFrame:
    """The texts that the eligibility rules read, empty where a source lacks them."""
    absent = [c for c in BACKFILLED_COLUMNS if c not in orders.columns]
    return orders.withColumns({c: F.lit("") for c in absent}) if absent else orders


def source_union(*sources: DataFrame) -> DataFrame:
    """All sources in one frame; columns that a source lacks are empty or null there."""
    union = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [backfill_columns(s) for s in sources],
    )
    names = [f.name for f in EXPORT_ORDER.fields if f.name in union.columns]
    return union.select(*names)


