"""Order rows of the three sources."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from parcelmart.functions import outcome, text
from parcelmart.operators import eligibility, normalize
from parcelmart.plans import build
from parcelmart.plans.shipments import shipments
from parcelmart.schemas import (
    EXPORT_FIELDS,
    EXPORT_ORDER,
    NORMALIZED_ORDER,
)
from parcelmart.sources import payloads

SF001 = "/root/testdata/sf0.01"


def orders(spark, ddl, *items, key="orders"):
    payload = json.dumps({"data": {"data": {key: list(items)}}})
    df = spark.createDataFrame([(payload,)], "payload string")
    return payloads.payload_explode(df, ddl)


def test_api1(spark):
    rows = normalize.api1_normalize(
        orders(
            spark, payloads.API1_ORDER,
            {},
            {"awb_number": " A1 ", "created_at": 1767225600, "is_cod": False, "cod": "0", "total": "1,000",
             "shipment": {"status_name": "PARTS", "cod": 50, "total_price": 0, "logistic": {"name": "L2", "rate_name": "Hemat"},
                          "logistic_name": "L3", "fee": "", "shipping_fee": 7.5},
             "logistic": {}, "receiver": {"address_detail": {"province": "P", "city": None}}},
            {"awb_number": "", "shipment_order_no": 12, "created_at": "never", "cod": None, "is_cod": 1,
             "shipment": {"status_name": "Retur", "pickup_time": "2026-02-03 10:00:00", "cod": "2,5"},
             "logistic": {"name": "L1", "rate_type_name": "Regular"}, "status_name": "Delivered"},
            {"status_name": "in process return", "logistic": None, "shipment": {"logistic_name": "L3"}},
        )
    ).collect()
    assert rows[0].asDict() == {
        "source_system": "api1", "order_id": "No Value", "event_date": None, "province": "No Value", "city": "No Value",
        "expedition": "No Value", "service_type": "No Value", "payment_method": "No Value", "cod_type": "NON-COD",
        "order_value": Decimal("0.00"), "cod_value": Decimal("0.00"), "shipping_fee": Decimal("0.00"),
        "return_flag": 0, "return_reason": "No Reason Provided",
    }
    a = rows[1]
    assert (a.order_id, a.event_date, a.expedition, a.service_type) == ("A1", dt.date(2026, 1, 1), "L2", "Eco")
    assert (a.cod_type, a.cod_value, a.order_value, a.shipping_fee) == ("NON-COD", 0, 1000, Decimal("7.5"))
    assert (a.return_flag, a.return_reason, a.city) == (1, "PARTS", "No Value")
    b = rows[2]
    assert (b.order_id, b.event_date, b.cod_type, b.cod_value) == ("12", dt.date(2026, 2, 3), "COD", 25)
    assert (b.return_flag, b.return_reason, b.service_type, b.expedition) == (1, "No Reason Provided", "Standard", "L1")
    assert (rows[3].return_flag, rows[3].expedition) == (0, "L3")


def test_api2(spark):
    rows = normalize.api2_normalize(
        orders(
            spark, payloads.API2_ORDER,
            {},
            {"cod_amount": 0, "order_info": {"order_sn": "", "order_id": 9, "ctime": 1767225600},
             "tracking_info": {"returning_start_time": 0, "returned_time": 5, "latest_tracking_reason": 0, "reason_code": 31},
             "finance_info": {"cod_service_fee": 2.5, "actual_shipping_fee": 0, "estimated_shipping_fee": "1,5"},
             "fulfillment_info": {"payment_method_rts": "wallet"}},
            key="list",
        )
    )
    first, second = rows.collect()
    assert (first.expedition, first.payment_method, first.return_flag, first.event_date) == ("SPX", "unknown", 0, None)
    assert (second.order_id, second.return_flag, second.return_reason) == ("9", 1, "Reason Code 31")
    assert (second.cod_type, second.cod_value, second.order_value, second.shipping_fee) == ("COD", Decimal("2.5"), 15, 0)
    assert second.event_date == dt.date(2026, 1, 1) and second.payment_method == "wallet"
    assert rows.columns == NORMALIZED_ORDER.names
    # Without a delivery status no API2 order is ever eligible.
    assert eligibility.eligible_orders(eligibility.eligibility_flags(rows)).count() == 0


def export(spark, **fields):
    values = [fields.get(f) for f in EXPORT_FIELDS]
    return spark.createDataFrame([values], ", ".join(f"{f} string" for f in EXPORT_FIELDS))


def test_export_row(spark):
    df = export(
        spark, tracking_no=" T1 ", created_at="04/03/2026 07:00", recipient_region="P / C / D", payment_role="NULL",
        original_pickup_option="No Value", actual_pickup_option="Drop", cod_collection_flag="YES", parcel_value="1,000.50",
        actual_shipping_fee="-", estimated_shipping_fee="9", returned_to_sender_at="not a date", delay_reason="rain",
        delivery_status="In Transit",
    )
    row = normalize.export_normalize(df)
    assert [(f.name, f.dataType) for f in row.schema] == [(f.name, f.dataType) for f in EXPORT_ORDER]
    r = row.first()
    assert (r.order_id, r.event_date, r.created_at) == ("T1", dt.date(2026, 3, 4), dt.datetime(2026, 3, 4, 7))
    assert (r.province, r.city, r.expedition, r.service_type) == ("P", "C", "SPX", "Drop")
    assert (r.payment_method, r.cod_type, r.order_value, r.shipping_fee) == ("No Value", "COD", Decimal("1000.50"), 9)
    # The return time counts as text even where it is no date.
    assert (r.return_flag, r.return_reason, r.returned_to_sender_at) == (1, "rain", None)


def test_safety_pass_of_texts(spark):
    record = {"source_system": "spx_web", "order_id": "a", "event_date": "2026-01-02", "service_type": "second",
              "order_value": "1,5", "cod_value": None, "return_flag": "x", "return_reason": " ", "expedition": ""}
    blob = json.dumps({"source_mode": "spx_web", "data": [record]})
    df = spark.createDataFrame([(blob,), ("[1]",)], "payload string")
    r = build.orders_from_envelopes(df).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.event_date, r.service_type, r.order_value, r.cod_value, r.return_flag) == (dt.date(2026, 1, 2), "Eco", 15, 0, 0)
    assert (r.return_reason, r.expedition, r.cod_type, r.province) == ("No Reason Provided", "SPX", "NON-COD", "No Value")


def test_api2_pages_in_an_old_envelope(spark):
    page = {"data": {"data": {"list": [{"order_info": {"order_sn": "s1"}}]}}}
    df = spark.createDataFrame([(json.dumps([page, page]),)], "payload string")
    assert [r.order_id for r in build.api2_orders_from_envelopes(df).collect()] == ["s1", "s1"]
    assert build.orders_from_envelopes(df).count() == 0


def test_source_union_fills_absent_columns(spark):
    a = spark.createDataFrame([("x",)], "order_id string")
    b = spark.createDataFrame([("y", "Delivered")], "order_id string, delivery_status string")
    rows = {r.order_id: r for r in normalize.source_union(a, b).collect()}
    assert rows["x"].delivery_status == "" and rows["y"].failed_reason == "" and rows["x"].return_reason == ""


def test_every_rule_has_its_rows(spark):
    names = ["returned_to_sender_at", "failed_reason", "delay_reason", "delivery_status"]
    df = shipments(spark, SF001, names)
    cleaned = df.select(*[text.clean_text(F.col(c), "", strict=True).alias(c) for c in names])
    rule = outcome.outcome_rule(*[F.col(c) for c in names])
    status = F.col("delivery_status")
    counts = cleaned.groupBy(rule.alias("rule"), text.final_status(status).alias("final")).count().collect()
    assert {(r.rule, r.final): r["count"] for r in counts} == {
        (1, 0): 6600, (1, 1): 4761, (2, 1): 15382, (3, 0): 8606, (3, 1): 8599, (4, 1): 4548, (5, 0): 901,
        (6, 0): 2979, (7, 0): 7624,
    }


def test_early_filter_is_the_general_rule(spark):
    texts = [None, "", "nan", "Cancelled", " delivered ", "Returned", "lost", "batal", "On Hold"]
    rows = [(f"{s}|{f}|{d}|{r}", s, f, d, r) for s in texts for f in texts for d in texts[:5] for r in (None, "2026-01-01")]
    df = spark.createDataFrame(
        rows, "tracking_no string, delivery_status string, failed_reason string, delay_reason string, returned_to_sender_at string"
    )
    df = df.select("*", *[F.lit("").alias(c) for c in EXPORT_FIELDS if c not in df.columns])
    late = eligibility.eligible_orders(eligibility.eligibility_flags(normalize.export_normalize(df)))
    early = normalize.export_normalize(eligibility.eligible_exports(df))
    assert sorted(r.order_id for r in late.select("order_id").collect()) == sorted(
        r.order_id for r in early.select("order_id").collect()
    )
    assert 0 < early.count() < df.count()


def test_latest_per_order(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), ("b", None, "only")], "order_id string, created_at int, city string"
    )
    got = eligibility.latest_per_order(df).orderBy("order_id").collect()
    assert [(r.order_id, r.city) for r in got] == [("a", "new"), ("b", "only")]
