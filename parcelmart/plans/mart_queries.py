"""The marts, their upsert, their checks and the incremental run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.functions.numbers import decimal_comma
from parcelmart.operators import marts
from parcelmart.operators.eligibility import add_week_keys, eligible_exports
from parcelmart.operators.normalize import bucket_services, export_normalize
from parcelmart.operators.quality import mart_quality as check_marts
from parcelmart.operators.tables import read_mart_or_empty, upsert_mart
from parcelmart.plans.build import all_marts, build_marts
from parcelmart.plans.build import raw_to_marts as take_raw
from parcelmart.plans.landing import land_orders, run_landed_quarter
from parcelmart.plans.loads import Layout, read_marts
from parcelmart.plans.oracle_sql import (
    GROUP,
    all_marts_sql,
    driver_sql,
    eligible_cte,
    reason_sql,
    weekly_sql,
)
from parcelmart.plans.registry import query
from parcelmart.plans.shipments import CARRIER_FIELDS, KEYS, api2_pages, carrier_shipments, export_lines, shipments
from parcelmart.plans.source_queries import land_exports
from parcelmart.schemas import BASE_KEYS, FACT_DRIVER, FACT_WEEKLY, SOURCE_EXPORT, WEEKLY_KEYS
from parcelmart.session import scratch_path, tidy
from parcelmart.sources.payloads import land_raw, read_raw
from parcelmart.streaming.incremental import apply_batch, landed_csv, landed_parquet, run_available

DRIVERS = ["service_type", "payment_method", "return_reason"]


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised export orders with suppliers as carriers."""
    return bucket_services(export_normalize(carrier_shipments(spark, sf_dir, part_first=True), "carrier"))


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible orders straight from the exports, dropped before they are parsed."""
    exports = eligible_exports(carrier_shipments(spark, sf_dir))
    return add_week_keys(bucket_services(export_normalize(exports, "carrier")))


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.order_measures(eligible(spark, sf_dir))


def written_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly base as a table: the driver mart reads it twice, the orders once."""
    path = scratch_path(spark, "base")
    base = marts.weekly_base(eligible(spark, sf_dir))
    base.write.parquet(path, compression="zstd")
    return spark.read.schema(base.schema).parquet(path)


def dated_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per mart keys and day as a table: batches of days are read from it."""
    path = scratch_path(spark, "dated")
    rows = marts.order_measures(eligible(spark, sf_dir), [*BASE_KEYS, "event_date"])
    days = marts.sum_by(rows, [*BASE_KEYS, "event_date"])
    days.write.parquet(path)
    return spark.read.schema(days.schema).parquet(path)


@query(eligible_cte() + weekly_sql())
def fact_returns_weekly(spark, sf_dir):
    return marts.fact_returns_weekly(measures(spark, sf_dir))


@query(eligible_cte() + reason_sql())
def fact_return_reason_weekly(spark, sf_dir):
    return marts.fact_return_reason_weekly(measures(spark, sf_dir))


@query(eligible_cte() + driver_sql())
def fact_return_driver_weekly(spark, sf_dir):
    return marts.fact_return_driver_weekly(written_base(spark, sf_dir))


@query(eligible_cte() + driver_sql(DRIVERS))
def driver_multi(spark, sf_dir):
    return marts.fact_return_driver_weekly(written_base(spark, sf_dir), DRIVERS)


def driver_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ranked_drivers(written_base(spark, sf_dir))


@query(
    f"""{eligible_cte()}, d AS ({driver_sql()})
SELECT {GROUP}, driver_type, driver_value, total_shipments, shipments_share FROM d"""
)
def driver_share(spark, sf_dir):
    facts = driver_facts(spark, sf_dir).withColumn("shipments_share", marts.shipments_share())
    return facts.select(*marts.DRIVER_KEYS, "total_shipments", "shipments_share")


@query(
    f"""{eligible_cte()}, d AS ({driver_sql()})
SELECT {GROUP}, driver_type, driver_value, return_rate, rank_in_group FROM d"""
)
def driver_rank(spark, sf_dir):
    facts = driver_facts(spark, sf_dir)
    return facts.select(*marts.DRIVER_KEYS, "return_rate", "rank_in_group")


@query(
    f"""{eligible_cte()}, d AS ({driver_sql()})
SELECT year, week_of_year, province, city, expedition, driver_value, rank_in_group,
  replace(format('{{:.6f}}', return_rate), '.', ',') AS return_rate,
  CAST(row_number() OVER (ORDER BY {", ".join(f"{k} NULLS LAST" for k in [*GROUP.split(", "), "driver_type"])},
    return_rate DESC NULLS LAST, driver_value NULLS LAST) - 1 AS BIGINT) AS position FROM d"""
)
def driver_sorted_export(spark, sf_dir):
    """The driver mart as sorted, compressed text files with decimal commas and the position of each row, read back."""
    path = scratch_path(spark, "sorted")
    mart = marts.fact_return_driver_weekly(written_base(spark, sf_dir))
    texts = marts.numbered_driver(mart).withColumn("return_rate", decimal_comma(F.col("return_rate")))
    texts.orderBy("position").write.csv(path, header=True, sep=";", compression="gzip")
    kept = GROUP.split(", ") + ["driver_value", "rank_in_group", "return_rate", "position"]
    schema = ", ".join(
        f"{f.name} {'STRING' if f.name == 'return_rate' else f.dataType.simpleString()}"
        for f in FACT_DRIVER.fields
    ) + ", position BIGINT"
    return spark.read.csv(path, schema=schema, header=True, sep=";").select(*kept)


@query(eligible_cte() + all_marts_sql())
def mart_build(spark, sf_dir):
    """The whole run: staging, weekly base and all marts as tables."""
    layout = Layout(scratch_path(spark, "build"))
    build_marts(spark, layout, orders(spark, sf_dir))
    return all_marts(read_marts(spark, layout))


FIRST_END, SECOND_START = dt.date(1998, 6, 10), dt.date(1998, 5, 20)


@query(
    f"""{eligible_cte()}, first AS ({weekly_sql(f"(SELECT * FROM eligible WHERE event_date <= DATE '{FIRST_END}' OR event_date IS NULL)")}),
second AS ({weekly_sql(f"(SELECT * FROM eligible WHERE event_date >= DATE '{SECOND_START}')")})
SELECT * FROM second UNION ALL
SELECT f.* FROM first f WHERE NOT EXISTS (SELECT 1 FROM second s
  WHERE {" AND ".join(f"f.{k} IS NOT DISTINCT FROM s.{k}" for k in WEEKLY_KEYS)})"""
)
def mart_upsert(spark, sf_dir):
    """Two batches that share some weeks; the second one is upserted twice."""
    path = scratch_path(spark, "mart")
    rows = dated_base(spark, sf_dir)
    date = F.col("event_date")
    batches = [
        rows.filter((date <= F.lit(FIRST_END)) | date.isNull()),
        rows.filter(date >= F.lit(SECOND_START)),
    ]
    for batch in [batches[0], batches[1], batches[1]]:
        upsert_mart(marts.fact_returns_weekly(batch), path, FACT_WEEKLY, WEEKLY_KEYS)
    return read_mart_or_empty(spark, path, FACT_WEEKLY)


QUARTERS = [dt.date(1997, 2, 10), dt.date(1997, 5, 10)]


@query(
    eligible_cte(
        "event_date IS NULL OR event_date BETWEEN DATE '1997-01-01' AND DATE '1997-07-06'"
        " OR (event_date BETWEEN DATE '1997-12-29' AND DATE '1997-12-31')"
    )
    + all_marts_sql()
)
def quarter_runs(spark, sf_dir):
    """Two weekly runs, one quarter each, both with the orders that have no date. The weeks at the
    edges are loaded whole, and so is week 1, which also holds the last days of December."""
    layout, landed = Layout(scratch_path(spark, "quarters")), orders(spark, sf_dir)
    land_orders(landed, layout, batch=1)
    for today in QUARTERS:
        run_landed_quarter(spark, layout, landed.schema, today)
    return all_marts(read_marts(spark, layout))


@query(
    f"""{eligible_cte()}, w AS ({weekly_sql()}), r AS ({reason_sql()}), d AS ({driver_sql()}),
n AS (SELECT count(*) AS n FROM eligible), g AS (SELECT sum(shipments_share) AS share, min(rank_in_group) AS first_rank FROM d GROUP BY {GROUP}, driver_type)
SELECT mart, check_name, CAST(violations AS BIGINT) AS violations FROM (
  {" UNION ALL ".join(f'''
  SELECT '{name}' AS mart, 'key_unique' AS check_name, (SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {keys} HAVING count(*) > 1)) AS violations
  UNION ALL SELECT '{name}', 'returns_in_bounds', (SELECT count(*) FROM {t} WHERE total_returns < 0 OR total_returns > total_shipments)
  UNION ALL SELECT '{name}', 'rate_is_ratio', (SELECT count(*) FROM {t} WHERE abs(return_rate - total_returns / total_shipments) > 1e-9)
  UNION ALL SELECT '{name}', 'total_is_eligible', (SELECT CASE WHEN sum(total_shipments) <> (SELECT n FROM n) THEN 1 ELSE 0 END FROM {t})'''
  for t, name, keys in [("w", "fact_returns_weekly", f"{GROUP}, service_type, payment_method, cod_type"),
                        ("r", "fact_return_reason_weekly", f"{GROUP}, service_type, return_reason"),
                        ("d", "fact_return_driver_weekly", f"{GROUP}, driver_type, driver_value")])}
  UNION ALL SELECT 'fact_return_driver_weekly', 'shares_sum_to_one', (SELECT count(*) FROM g WHERE abs(share - 1) > 1e-9)
  UNION ALL SELECT 'fact_return_driver_weekly', 'first_rank_is_one', (SELECT count(*) FROM g WHERE first_rank <> 1))"""
)
def mart_quality(spark, sf_dir):
    """The checks over written marts; the orders are read once, for the base and their number."""
    path = scratch_path(spark, "quality")
    rows = eligible(spark, sf_dir).select("order_id", "return_flag", "order_value", "cod_value", "shipping_fee", *BASE_KEYS)
    rows.write.parquet(f"{path}/orders")
    rows = spark.read.schema(rows.schema).parquet(f"{path}/orders")
    base = marts.weekly_base(rows)
    base.write.parquet(f"{path}/base")
    built = marts.marts_from(spark.read.schema(base.schema).parquet(f"{path}/base"))
    for name, mart in built.items():
        mart.write.parquet(f"{path}/{name}")
    written = [spark.read.schema(mart.schema).parquet(f"{path}/{name}") for name, mart in built.items()]
    return check_marts(rows, *written)


@query(eligible_cte() + all_marts_sql())
def incremental_weeks(spark, sf_dir):
    """Exports landed in several files, taken in a few at a time by a file stream; the
    marts must be those of one batch."""
    folder = scratch_path(spark, "stream")
    lines = export_lines(spark, sf_dir, CARRIER_FIELDS).repartition(6, *KEYS)  # what tracking numbers are made of
    with tidy(spark):
        carrier_shipments(spark, sf_dir, lines).write.parquet(f"{folder}/landed")
    stream = landed_parquet(spark, f"{folder}/landed", ["carrier"], files_per_batch=3)
    layout = Layout(f"{folder}/warehouse")
    run_available(spark, stream, layout, expedition="carrier")
    return all_marts(read_marts(spark, layout))


@query(eligible_cte() + all_marts_sql())
def incremental_reload(spark, sf_dir):
    """Orders that land twice: a third of them first with another status, region or date, a third
    twice alike. The marts must be those of the last rows."""
    folder = scratch_path(spark, "reload")
    with tidy(spark):
        carrier_shipments(spark, sf_dir, part_first=True).write.parquet(f"{folder}/landed")
    landed = spark.read.parquet(f"{folder}/landed")
    third = F.pmod(F.xxhash64("tracking_no"), F.lit(3))
    turn = F.pmod(F.xxhash64("tracking_no"), F.lit(7))
    old = third == 0
    first = landed.withColumns(
        {
            "delivery_status": F.when(old & (turn < 2), "Returned").when(old & (turn == 2), "Cancelled").otherwise(F.col("delivery_status")),
            "recipient_region": F.when(old & (turn == 3), "Elsewhere / Town / T").otherwise(F.col("recipient_region")),
            "created_at": F.when(old & (turn > 3), "2001-02-03 04:05:06").otherwise(F.col("created_at")),
        }
    )
    layout = Layout(f"{folder}/warehouse")
    apply_batch(layout, first, 0, "carrier")
    for _ in range(2):  # the second time is a replay
        apply_batch(layout, landed.filter(third < 2), 1, "carrier")
    return all_marts(read_marts(spark, layout))


@query(eligible_cte(carrier="'SPX'") + all_marts_sql())
def incremental_csv(spark, sf_dir):
    """CSV files of two languages, some with a title line and other columns, taken in by a stream."""
    folder = scratch_path(spark, "csv_stream")
    land_exports(spark, sf_dir, f"{folder}/landed")
    layout = Layout(f"{folder}/warehouse")
    run_available(spark, landed_csv(spark, f"{folder}/landed"), layout)
    return all_marts(read_marts(spark, layout))


def envelopes(normalized: DataFrame) -> DataFrame:
    """One payload for each normalised order, in an envelope."""
    record = F.to_json(F.struct(*normalized.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"})
    return normalized.select(
        F.lit(SOURCE_EXPORT).alias("source"),
        F.col("customer_reference_no").cast("long").alias("page"),
        F.concat(F.lit(f'{{"source_mode":"{SOURCE_EXPORT}","data":['), record, F.lit("]}")).alias("payload"),
    )


@query(eligible_cte(carrier="'SPX'") + all_marts_sql())
def raw_to_marts(spark, sf_dir):
    """Envelopes of two runs and pages of the second API as landed payloads, the newest of each
    taken to the marts. Rows of the API carry no status, so the marts hold the envelopes' orders."""
    folder = scratch_path(spark, "raw_to_marts")
    with tidy(spark):
        export_normalize(shipments(spark, sf_dir, part_first=True)).write.parquet(f"{folder}/orders")
    rows = spark.read.parquet(f"{folder}/orders")
    layout = Layout(f"{folder}/warehouse")
    pages = api2_pages(spark, sf_dir).select(F.lit("api2").alias("source"), "page", "payload")
    older = envelopes(rows.withColumn("delivery_status", F.lit("Returned")))

    def land(part: DataFrame, day: str) -> None:
        land_raw(part.withColumn("run_ts", F.lit(f"2026-01-{day} 01:00:00").cast("timestamp")), layout.raw)

    for part, day in ((older, "05"), (envelopes(rows), "12"), (pages, "12")):
        land(part, day)
    # The pages are made once: in envelopes they come from where they have landed.
    landed = read_raw(spark, layout.raw).filter(F.col("source") == "api2")
    body = F.concat(F.lit('{"source_mode":"api","data":['), F.col("payload"), F.lit("]}"))
    land(landed.select(F.lit(SOURCE_EXPORT).alias("source"), "page", body.alias("payload")), "12")
    take_raw(spark, layout, {SOURCE_EXPORT: "envelope", "api2": "api2"})
    return all_marts(read_marts(spark, layout))
