"""Scalar rules over whole tables. Inputs are written in SQL that Spark and DuckDB
read alike, so that both sides start from the same texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.functions import dates, numbers, outcome, text
from parcelmart.operators.eligibility import add_week_keys
from parcelmart.operators.eligibility import quarter_filter as orders_of_quarter
from parcelmart.plans.oracle_sql import RULED_CTE, SHIP_CTE
from parcelmart.plans.registry import query
from parcelmart.plans.shipments import KEYS, line_items, shipments, table
from parcelmart.schemas import NOT_RETURN_WORDS, RETURN_WORDS

KEY_SQL = ", ".join(KEYS)


def inputs(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    """Line-item keys with input columns given as SQL."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(*KEYS, *[F.expr(sql).alias(name) for name, sql in columns.items()])


def outputs(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*KEYS, *[c.alias(name) for name, c in columns.items()])


def given(**columns: str) -> str:
    """The same inputs as a DuckDB common table expression."""
    selected = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"WITH given AS (SELECT {KEY_SQL}, {selected} FROM lineitem)"


BLANKS = "' ' || chr(9) || chr(10) || chr(13)"

MESSY_TEXT = """CASE (l_orderkey + l_linenumber) % 9
  WHEN 0 THEN '  ' || l_returnflag || chr(9) || ' x' || chr(10) WHEN 1 THEN 'NaN' WHEN 2 THEN ' null '
  WHEN 3 THEN '' WHEN 4 THEN CAST(NULL AS STRING) WHEN 5 THEN chr(9) || chr(10) || ' '
  WHEN 6 THEN 'None' WHEN 7 THEN 'nat' ELSE CAST(l_suppkey AS STRING) END"""


@query(
    f"""{given(x=MESSY_TEXT)}, t AS (SELECT *, trim(x, {BLANKS}) AS s FROM given)
SELECT {KEY_SQL}, coalesce(nullif(s, ''), 'No Value') AS basic_text,
  CASE WHEN s IS NULL OR lower(s) IN ('', 'nan', 'nat', 'none', 'null') THEN 'No Value' ELSE s END AS strict_text
FROM t"""
)
def clean_text(spark, sf_dir):
    df = inputs(spark, sf_dir, x=MESSY_TEXT)
    return outputs(
        df,
        basic_text=text.clean_text(F.col("x")),
        strict_text=text.clean_text(F.col("x"), strict=True),
    )


PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)"
NUMBER_TEXT = f"""CASE (l_orderkey + l_linenumber) % 17
  WHEN 0 THEN substr({PRICE}, 1, 2) || ',' || substr({PRICE}, 3) WHEN 1 THEN ' ' || {PRICE} || ' '
  WHEN 2 THEN {PRICE} || 'd' WHEN 3 THEN 'Rp ' || {PRICE} WHEN 4 THEN '-' WHEN 5 THEN ''
  WHEN 6 THEN CAST(NULL AS STRING) WHEN 7 THEN '.' || CAST(l_suppkey AS STRING)
  WHEN 8 THEN '+' || CAST(l_partkey AS STRING) WHEN 9 THEN '1e' || CAST(l_linenumber AS STRING)
  WHEN 10 THEN 'nan' WHEN 11 THEN 'inf' WHEN 12 THEN '1.234,' || CAST(l_partkey AS STRING)
  WHEN 13 THEN '-' || {PRICE} WHEN 14 THEN '1f' WHEN 15 THEN '1e999' ELSE {PRICE} END"""


@query(
    rf"""{given(x=NUMBER_TEXT)}, t AS (SELECT *, trim(replace(x, ',', '')) AS s FROM given)
SELECT {KEY_SQL}, CASE WHEN s = '1e999' THEN CAST(0 AS DOUBLE)
  WHEN regexp_full_match(s, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(s AS DOUBLE)
  ELSE CAST(0 AS DOUBLE) END AS number
FROM t"""
)
def parse_number(spark, sf_dir):
    df = inputs(spark, sf_dir, x=NUMBER_TEXT)
    return outputs(df, number=numbers.parse_number(F.col("x")))


DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
Y, M, D = f"substr({DAY}, 1, 4)", f"substr({DAY}, 6, 2)", f"substr({DAY}, 9, 2)"
API_TIME_TEXT = f"""CASE (l_orderkey + l_linenumber) % 9
  WHEN 0 THEN CAST(l_orderkey * 86400 + 61 AS STRING) WHEN 1 THEN {DAY} WHEN 2 THEN {DAY} || 'T10:20:30'
  WHEN 3 THEN {DAY} || ' 04:05' WHEN 4 THEN '' WHEN 5 THEN CAST(NULL AS STRING) WHEN 6 THEN 'garbage'
  WHEN 7 THEN {M} || '/' || {D} || '/' || {Y} ELSE '0' END"""


@query(
    f"""WITH t AS (SELECT *, (l_orderkey + l_linenumber) % 9 AS k, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS d FROM lineitem)
SELECT {KEY_SQL}, strftime(CASE k WHEN 0 THEN TIMESTAMP '1970-01-01' + to_days(CAST(l_orderkey AS INTEGER)) + INTERVAL 61 SECOND
  WHEN 1 THEN d WHEN 2 THEN d + INTERVAL 37230 SECOND WHEN 3 THEN d + INTERVAL 245 MINUTE WHEN 7 THEN d
  WHEN 8 THEN TIMESTAMP '1970-01-01' END, '%Y-%m-%d %H:%M:%S') AS ts
FROM t"""
)
def parse_ts_api(spark, sf_dir):
    df = inputs(spark, sf_dir, x=API_TIME_TEXT)
    return outputs(
        df, ts=F.date_format(dates.parse_ts_api(F.col("x")), "yyyy-MM-dd HH:mm:ss")
    )


# Variant 3 is month-first where the day cannot be a month, else day-first.
EXPORT_TIME_TEXT = f"""CASE (l_orderkey + l_linenumber) % 9
  WHEN 0 THEN {D} || '/' || {M} || '/' || {Y} WHEN 1 THEN ' ' || {DAY} || ' ' WHEN 2 THEN {D} || '-' || {M} || '-' || {Y} || ' 08:09'
  WHEN 3 THEN CASE WHEN CAST({D} AS INTEGER) > 12 THEN {M} || '/' || {D} || '/' || {Y} ELSE {D} || '/' || {M} || '/' || {Y} END
  WHEN 4 THEN '' WHEN 5 THEN CAST(NULL AS STRING) WHEN 6 THEN '45000' WHEN 7 THEN {DAY} || 'T10:20:30'
  ELSE CAST(CAST({D} AS INTEGER) AS STRING) || '/' || CAST(CAST({M} AS INTEGER) AS STRING) || '/' || {Y} || ' 7:8:9' END"""
EXPORT_TIMES = f"""WITH t AS (SELECT *, (l_orderkey + l_linenumber) % 9 AS k, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS d FROM lineitem),
u AS (SELECT *, CASE WHEN k IN (0, 1, 3) THEN d WHEN k = 2 THEN d + INTERVAL 489 MINUTE
  WHEN k = 7 THEN d + INTERVAL 37230 SECOND WHEN k = 8 THEN d + INTERVAL 25689 SECOND END AS ts FROM t)"""


@query(f"{EXPORT_TIMES} SELECT {KEY_SQL}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM u")
def parse_ts_dayfirst(spark, sf_dir):
    df = inputs(spark, sf_dir, x=EXPORT_TIME_TEXT)
    return outputs(
        df, ts=F.date_format(dates.parse_ts_dayfirst(F.col("x")), "yyyy-MM-dd HH:mm:ss")
    )


@query(
    f"""{EXPORT_TIMES} SELECT {KEY_SQL},
  CASE WHEN ts IS NOT NULL THEN strftime(ts, '%Y-%m-%d') WHEN k = 4 THEN '' WHEN k = 6 THEN '45000' END AS day
FROM u"""
)
def date_text(spark, sf_dir):
    df = inputs(spark, sf_dir, x=EXPORT_TIME_TEXT)
    return outputs(df, day=dates.date_text(F.col("x")))


REGION_TEXT = """CASE (l_orderkey + l_linenumber) % 9
  WHEN 0 THEN l_returnflag || ' / ' || l_linestatus || ' / z' WHEN 1 THEN l_returnflag WHEN 2 THEN '/ /'
  WHEN 3 THEN l_returnflag || '//' || l_linestatus WHEN 4 THEN CAST(NULL AS STRING) WHEN 5 THEN ' nan '
  WHEN 6 THEN ' / /' || l_linestatus WHEN 7 THEN l_linestatus || '/ / ' ELSE '/' || l_returnflag || '/' || CAST(l_suppkey AS STRING) END"""


@query(
    f"""{given(x=REGION_TEXT)}, t AS (
  SELECT *, CASE WHEN trim(x) = 'nan' THEN [] ELSE [trim(p) FOR p IN string_split(x, '/') IF trim(p) <> ''] END AS parts FROM given)
SELECT {KEY_SQL}, coalesce(parts[1], 'No Value') AS province, coalesce(parts[2], 'No Value') AS city FROM t"""
)
def split_region(spark, sf_dir):
    df = inputs(spark, sf_dir, x=REGION_TEXT)
    province, city = text.split_region(F.col("x"))
    return outputs(df, province=province, city=city)


@query(
    f"""{SHIP_CTE} SELECT tracking_no,
  CASE WHEN payment_role IN ('', 'nan') THEN 'No Value' ELSE payment_role END AS payment_text,
  CASE payment_role WHEN 'COD' THEN 'COD' ELSE 'NON-COD' END AS payment_cod_type
FROM ship"""
)
def cod_payment_role(spark, sf_dir):
    df = shipments(spark, sf_dir, ["tracking_no", "payment_role"])
    payment, kind = text.cod_payment_role(F.col("payment_role"))
    return df.select(
        "tracking_no", payment.alias("payment_text"), kind.alias("payment_cod_type")
    )


@query(
    f"""{SHIP_CTE} SELECT tracking_no,
  CASE WHEN (c_mktsegment = 'BUILDING' AND l_extendedprice > 0) OR cod_flag IN ('Y', 'yes') THEN 'COD' ELSE 'NON-COD' END AS cod_type,
  CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN l_extendedprice ELSE 0 END AS DOUBLE) AS cod_amount
FROM ship"""
)
def cod_fields(spark, sf_dir):
    df = shipments(spark, sf_dir, ["tracking_no", "cod_amount", "cod_collection_flag"])
    parsed = df.withColumn("cod_amount", numbers.parse_number(F.col("cod_amount")))
    kind = text.cod_type(F.col("cod_amount"), F.col("cod_collection_flag"))
    return parsed.select("tracking_no", kind.alias("cod_type"), "cod_amount")


@query(
    f"""{RULED_CTE} SELECT tracking_no, CAST(CASE WHEN rule = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_cancelled FROM ruled"""
)
def cancel_keyword(spark, sf_dir):
    df = shipments(
        spark, sf_dir, ["tracking_no", "delivery_status", "failed_reason", "delay_reason"]
    )
    words = [F.col(c) for c in ("delivery_status", "failed_reason", "delay_reason")]
    return df.select("tracking_no", text.cancel_keyword(*words).alias("is_cancelled"))


@query(
    f"""{SHIP_CTE} SELECT tracking_no,
  CAST(CASE WHEN lower(delivery_status) IN ('delivered', 'returned', 'damaged', 'lost') THEN 1 ELSE 0 END AS INTEGER) AS is_final_status
FROM ship"""
)
def final_status(spark, sf_dir):
    df = shipments(spark, sf_dir, ["tracking_no", "delivery_status"])
    return df.select(
        "tracking_no", text.final_status(F.col("delivery_status")).alias("is_final_status")
    )


@query(
    f"""{RULED_CTE} SELECT tracking_no, CAST(rule AS INTEGER) AS rule,
  CAST(CASE WHEN rule IN (3, 4, 5) THEN 1 ELSE 0 END AS INTEGER) AS return_flag,
  CASE WHEN rule = 1 THEN 'Cancelled' WHEN rule IN (2, 7) THEN 'No Reason Provided' WHEN rule IN (5, 6) THEN failed_reason
       WHEN failed_reason <> '' THEN failed_reason WHEN delay_reason <> '' THEN delay_reason ELSE delivery_status END AS return_reason
FROM ruled"""
)
def return_classify(spark, sf_dir):
    names = ["returned_to_sender_at", "failed_reason", "delay_reason", "delivery_status"]
    df = shipments(spark, sf_dir, ["tracking_no"] + names)
    cleaned = df.select(
        "tracking_no", *[text.clean_text(F.col(c), "", strict=True).alias(c) for c in names]
    )
    returned, failed, delay, status = (F.col(c) for c in names)
    ruled = cleaned.withColumn("rule", outcome.outcome_rule(returned, failed, delay, status))
    rule = F.col("rule")
    return ruled.select(
        "tracking_no",
        "rule",
        outcome.outcome_flag(rule).alias("return_flag"),
        outcome.outcome_reason(rule, failed, delay, status).alias("return_reason"),
    )


SERVICE_TEXT = """CASE (l_orderkey + l_linenumber) % 8
  WHEN 0 THEN 'Hemat' WHEN 1 THEN 'second day' WHEN 2 THEN ' REGULAR ' WHEN 3 THEN ' Drop Off '
  WHEN 4 THEN CAST(NULL AS STRING) WHEN 5 THEN 'STANDARD ' || l_returnflag WHEN 6 THEN ' '
  ELSE 'option ' || CAST(l_suppkey AS STRING) END"""


@query(
    f"""{given(x=SERVICE_TEXT)} SELECT {KEY_SQL},
  CASE (l_orderkey + l_linenumber) % 8 WHEN 0 THEN 'Eco' WHEN 1 THEN 'Eco' WHEN 2 THEN 'Standard' WHEN 3 THEN 'Drop Off'
    WHEN 4 THEN 'No Value' WHEN 5 THEN 'Standard' WHEN 6 THEN 'No Value' ELSE x END AS service_type
FROM given"""
)
def service_bucket(spark, sf_dir):
    df = inputs(spark, sf_dir, x=SERVICE_TEXT)
    return outputs(df, service_type=text.service_bucket(F.col("x")))


@query(
    """SELECT o_orderkey, CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS quarter_start,
  CAST(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS quarter_end
FROM orders"""
)
def quarter_range(spark, sf_dir):
    start, end = dates.quarter_range(F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        start.cast("string").alias("quarter_start"),
        end.cast("string").alias("quarter_end"),
    )


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week_of_year,
  CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders)"""
)
def week_keys(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate")).cast("date").alias("event_date"),
    )
    iso_year = dates.week_keys(F.col("event_date"), iso_year=True)["year"]
    return add_week_keys(dated).select(
        "o_orderkey", "year", "week_of_year", iso_year.alias("iso_year")
    )


QUARTER_DAY = dt.date(1997, 5, 15)


@query(
    f"""SELECT {KEY_SQL}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS event_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate >= TIMESTAMP '1997-04-01' AND o_orderdate < TIMESTAMP '1997-07-01'"""
)
def quarter_filter(spark, sf_dir):
    rows = orders_of_quarter(line_items(spark, sf_dir, ["orders"]), QUARTER_DAY, "o_orderdate")
    return outputs(rows, event_date=F.col("o_orderdate").cast("date").cast("string"))


RATIO = "CASE WHEN l_linenumber <> 5 THEN l_extendedprice / (l_quantity * 7) END"


@query(
    f"""{given(x=RATIO)} SELECT {KEY_SQL}, coalesce(replace(format('{{:.6f}}', x), '.', ','), '') AS text FROM given"""
)
def decimal_comma(spark, sf_dir):
    df = inputs(spark, sf_dir, x=RATIO)
    return outputs(df, text=numbers.decimal_comma(F.col("x")))


LATEST_TEXT = """CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN CAST(NULL AS STRING) WHEN 3 THEN 'unknown'
  WHEN 4 THEN ' Bad address ' WHEN 5 THEN '' WHEN 6 THEN 'None' ELSE CAST(l_suppkey AS STRING) END"""
CODE_TEXT = """CASE l_orderkey % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '0' WHEN 2 THEN 'Unknown'
  ELSE CAST(l_partkey AS STRING) END"""


@query(
    f"""{given(latest=LATEST_TEXT, code=CODE_TEXT)},
t AS (SELECT *, trim(CASE WHEN latest IS NULL OR latest IN ('', '0') THEN code ELSE latest END) AS s FROM given)
SELECT {KEY_SQL}, CASE WHEN s IS NULL THEN 'No Value' WHEN s IN ('0', 'unknown', 'Unknown', 'None') THEN 'No Reason Provided'
  WHEN regexp_full_match(s, '[0-9]+') THEN 'Reason Code ' || s ELSE s END AS reason
FROM t"""
)
def reason_code_text(spark, sf_dir):
    df = inputs(spark, sf_dir, latest=LATEST_TEXT, code=CODE_TEXT)
    return outputs(df, reason=text.reason_code_text(F.col("latest"), F.col("code")))


STATUS_TEXT = """CASE (l_orderkey + l_linenumber) % 9 WHEN 0 THEN 'Return to sender' WHEN 1 THEN 'In process return'
  WHEN 2 THEN 'spare parts ' || CAST(l_partkey AS STRING) WHEN 3 THEN 'Delivered' WHEN 4 THEN CAST(NULL AS STRING)
  WHEN 5 THEN 'Cancelled by courier (refused)' WHEN 6 THEN 'cancelled by courier' WHEN 7 THEN 'Barang ditolak, in process return'
  ELSE 'Gagal antar' END"""


@query(
    f"""SELECT {KEY_SQL}, CAST(CASE WHEN (l_orderkey + l_linenumber) % 9 IN (0, 2, 5, 8) THEN 1 ELSE 0 END AS INTEGER) AS is_return
FROM lineitem"""
)
def keyword_return(spark, sf_dir):
    df = inputs(spark, sf_dir, x=STATUS_TEXT)
    matched = text.keyword_match(F.col("x"), RETURN_WORDS, NOT_RETURN_WORDS)
    return outputs(df, is_return=matched.cast("int"))
