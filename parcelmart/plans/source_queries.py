"""Payloads, export files, links and normalised orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.operators import eligibility, normalize, tables
from parcelmart.plans import build
from parcelmart.plans.oracle_sql import (
    API1,
    API2,
    EXPORT_COLUMNS,
    NORM,
    NORM_CTE,
    ORDER_COLUMNS,
    RULED,
    SHIP,
    SHIP_CTE,
)
from parcelmart.plans.registry import query
from parcelmart.plans.shipments import FIELDS, api1_pages, api2_pages, export_lines, shipments, source_lines, table
from parcelmart.schemas import (
    EXPORT_FIELDS,
    EXPORT_HEADERS,
    EXPORT_ORDER,
    REGION_PARTS,
    SOURCE_EXPORT,
)
from parcelmart.session import scratch_path, tidy
from parcelmart.sources import exports, links, payloads

# ---------------------------------------------------------------- output shapes


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text and money as double, as the oracles give them."""
    shown = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            c = c.cast("double")
        shown.append(c.alias(field.name))
    return df.select(*shown)


def english(field: str) -> str:
    return EXPORT_HEADERS[field][-1]


def with_headers(df: DataFrame, place: int) -> DataFrame:
    """Fields under their first (0) or last (-1) header."""
    return df.select(*[F.col(f).alias(EXPORT_HEADERS[f][place]) for f in df.columns])


# ---------------------------------------------------------------- JSON payloads


@query(
    f"{SHIP_CTE} SELECT CASE WHEN l_linenumber <> 2 THEN tracking_no END AS tracking_no, customer_reference_no FROM ship"
)
def payload_explode(spark, sf_dir):
    orders = payloads.payload_explode(api2_pages(spark, sf_dir), payloads.API2_ORDER)
    info = F.col("order.order_info")
    return orders.select(
        info["order_sn"].alias("tracking_no"), info["order_id"].alias("customer_reference_no")
    )


@query(f"WITH {SHIP}, {API1} SELECT {ORDER_COLUMNS} FROM api1_norm")
def api1_normalize(spark, sf_dir):
    orders = payloads.payload_explode(api1_pages(spark, sf_dir), payloads.API1_ORDER)
    return plain(normalize.api1_normalize(orders))


@query(f"WITH {SHIP}, {API2} SELECT {ORDER_COLUMNS} FROM api2_norm")
def api2_normalize(spark, sf_dir):
    orders = payloads.payload_explode(api2_pages(spark, sf_dir), payloads.API2_ORDER)
    return plain(normalize.api2_normalize(orders))


# One payload per order and load time, in SQL that both engines read.
RAW_JSON = """'{"id":' || CAST(o_orderkey AS STRING) || ',"status":"' || o_orderstatus || '"}'"""
RAW_SOURCE = "CASE WHEN o_orderkey % 3 = 0 THEN 'api1' ELSE 'api2' END"


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of many runs: the order date stands for the run time."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("run_ts"),
        F.expr(RAW_SOURCE).alias("source"),
        F.col("o_orderkey").alias("page"),
        F.expr(RAW_JSON).alias("payload"),
    )


def landed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    pages = raw_pages(spark, sf_dir)
    # Two appends; the run date is coarsened so that the test data make few folders.
    late = F.year("run_ts") >= 1998
    for half in (pages.filter(~late), pages.filter(late)):
        yearly = half.withColumn("run_ts", F.trunc("run_ts", "year"))
        payloads.land_raw(yearly.repartition("source", "run_ts"), path)
    return payloads.read_raw(spark, path)


@query(
    f"""SELECT {RAW_SOURCE} AS source, CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) AS run_date,
  o_orderkey AS page, {RAW_JSON} AS payload FROM orders"""
)
def raw_landing(spark, sf_dir):
    raw = landed_raw(spark, sf_dir)
    return raw.select("source", F.col("run_date").cast("string"), "page", "payload")


@query(
    f"""WITH raw AS (SELECT *, {RAW_SOURCE} AS source FROM orders)
SELECT source, o_orderkey AS page, {RAW_JSON} AS payload FROM raw r
WHERE o_orderdate = (SELECT max(o_orderdate) FROM raw m WHERE m.source = r.source)"""
)
def latest_payload(spark, sf_dir):
    raw = raw_pages(spark, sf_dir)
    newest = [payloads.latest_payload(raw, source) for source in ("api1", "api2")]
    return newest[0].unionByName(newest[1]).select("source", "page", "payload")


ENVELOPE = """CASE o_orderkey % 5
  WHEN 0 THEN '{"source_mode":"spx_web","data":[{"order_id":"' || CAST(o_orderkey AS STRING) || '"},{"order_id":"second"}]}'
  WHEN 1 THEN '[{"order_id":"' || CAST(o_orderkey AS STRING) || '"}]'
  WHEN 2 THEN '{"source_mode":"other","data":[{"order_id":' || CAST(o_orderkey AS STRING) || '}, {}]}'
  WHEN 3 THEN '{"data":[{"order_id":"lost"}]}' ELSE 'no json' END"""


@query(
    """WITH items AS (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'spx_web' WHEN 1 THEN 'api' ELSE 'other' END AS mode, pos,
    CASE WHEN pos = 0 THEN CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 5 = 0 THEN 'second' END AS order_id
  FROM orders, (VALUES (0), (1)) p(pos) WHERE o_orderkey % 5 IN (0, 2) OR (o_orderkey % 5 = 1 AND pos = 0))
SELECT o_orderkey, mode, CAST(pos AS INTEGER) AS pos, order_id FROM items"""
)
def envelope_decode(spark, sf_dir):
    blobs = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(ENVELOPE).alias("payload"))
    items = payloads.envelope_decode(blobs)
    record = payloads.item_as(F.col("item"), "order_id STRING")
    return items.select("o_orderkey", "mode", "pos", record["order_id"].alias("order_id"))


# ---------------------------------------------------------------- export files


CSV_WRITE = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}


def write_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    df.write.options(**CSV_WRITE).csv(path, compression=compression)
    return path


CSV_FIELDS = [
    "tracking_no", "created_at", "recipient_region", "recipient_address", "payment_role",
    "parcel_value", "cod_amount", "delivery_status",
]


@query(
    f"""{SHIP_CTE} SELECT tracking_no AS "Nomer Resi", nullif(created_text, '') AS "Waktu dibuat",
  r_name || ' / ' || n_name || ' / ' || c_mktsegment AS "Provinsi/Kota/Kecamatan Penerima",
  'Street ' || l_suppkey || ', "Block" ' || l_linenumber AS "Alamat Detail Penerima",
  CASE WHEN payment_role NOT IN ('', 'nan') THEN payment_role END AS "Payment Role", parcel_text AS "Nilai Parcel",
  CASE WHEN c_mktsegment = 'BUILDING' THEN parcel_text END AS "Jumlah COD", delivery_status AS "Status Pengiriman"
FROM ship"""
)
def export_csv_scan(spark, sf_dir):
    rows = with_headers(shipments(spark, sf_dir, CSV_FIELDS), 0)
    return exports.export_csv_scan(spark, write_csv(rows, scratch_path(spark, "export")))


def english_export() -> list[Column]:
    """The cells of exports under English headers, the recipient region in three, made from ``export_lines``."""
    whole = [f for f in EXPORT_FIELDS if f not in REGION_PARTS]
    places = ["province_name", "city_name", "segment"]
    return [
        *[F.expr(FIELDS[f][0]).alias(english(f)) for f in whole],
        *[F.expr(FIELDS[p][0]).alias(h) for p, h in zip(places, REGION_PARTS["recipient_region"])],
        *[F.lit("").alias(h) for h in REGION_PARTS["pickup_region"]],
    ]


@query(
    f"""{SHIP_CTE} SELECT tracking_no, created_text AS created_at, payment_role, 'CUSTOM' AS extra FROM ship"""
)
def export_alias_rename(spark, sf_dir):
    fields = ["tracking_no", "created_at", "payment_role"]
    rows = with_headers(shipments(spark, sf_dir, fields), -1)
    return exports.alias_rename(rows.withColumn("extra", F.lit("CUSTOM")))


@query(
    f"""{SHIP_CTE} SELECT tracking_no,
  r_name || ' / ' || CASE WHEN l_linenumber = 1 THEN '' ELSE n_name END || ' / ' || c_mktsegment AS recipient_region
FROM ship"""
)
def region_synthesis(spark, sf_dir):
    parts = REGION_PARTS["recipient_region"]
    rows = shipments(
        spark, sf_dir, ["tracking_no", "province_name", "city_name", "segment"], keys=True
    ).select(
        "tracking_no",
        F.concat(F.lit(" "), "province_name", F.lit("\t")).alias(parts[0]),
        F.when(F.col("l_linenumber") != 1, F.col("city_name")).alias(parts[1]),
        F.col("segment").alias(parts[2]),
    )
    return exports.region_synthesis(rows).select("tracking_no", "recipient_region")


TITLED_ROWS = 100_000


def write_titled_csv(
    df: DataFrame, path: str, rows: int = 0, cells: list[Column] | None = None, compression: str = "none"
) -> str:
    """CSV files with a title line above the header row, of about ``TITLED_ROWS`` of the ``rows`` that there
    are: a task writes and reads one file, whatever the number of rows. ``cells`` are made of the columns of
    ``df`` after its rows have been moved to their file, which moves less where these are narrower."""
    spark = df.sparkSession
    names = df.columns if cells is None else df.select(*cells).columns
    titles = [f"Report {i}" for i in range(len(names))]
    if cells is None:
        df = df.toDF(*titles)
        cells = [F.col(f"`{t}`") for t in titles]
    files = max(2, spark.sparkContext.defaultParallelism // 4, -(-rows // TITLED_ROWS))
    part = F.pmod(F.xxhash64(*[f"`{c}`" for c in df.columns]), F.lit(files))
    data = df.select(F.lit(1).alias("line"), part.alias("part"), "*")
    header = spark.range(files).select(F.lit(0).alias("line"), F.col("id").alias("part"))
    placed = data.unionByName(header, allowMissingColumns=True).repartition(files, "part").sortWithinPartitions("part", "line")
    is_header = F.col("line") == 0
    texts = [F.when(is_header, F.lit(n)).otherwise(c.cast("string")).alias(t) for n, c, t in zip(names, cells, titles)]
    with tidy(spark):
        placed.select("part", *texts).write.partitionBy("part").options(**CSV_WRITE).csv(path, compression=compression)
    return f"{path}/part=*"


def land_exports(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """Compressed exports of all shipments: titled ones with English headers, and those of the tracking numbers
    that end in 7 with local headers. Gives what to read."""
    is_local = F.endswith(F.expr(FIELDS["tracking_no"][0]), F.lit("7"))
    lines = export_lines(spark, sf_dir)
    n_lines = table(spark, sf_dir, "lineitem").count()
    titled = write_titled_csv(lines.filter(~is_local), f"{folder}/english", n_lines, english_export(), "gzip")
    with tidy(spark):
        local = write_csv(with_headers(shipments(spark, sf_dir, lines=lines.filter(is_local)), 0), f"{folder}/local", "gzip")
    return [titled, local]


@query(
    f"""{SHIP_CTE} SELECT tracking_no, nullif(created_text, '') AS created_at,
  r_name || ' / ' || n_name || ' / ' || c_mktsegment AS recipient_region,
  'Street ' || l_suppkey || ', "Block" ' || l_linenumber AS recipient_address,
  parcel_text AS parcel_value, delivery_status FROM ship"""
)
def export_header_repair(spark, sf_dir):
    rows = exports.read_exports(spark, land_exports(spark, sf_dir, scratch_path(spark, "landed")))
    return rows.select(
        "tracking_no", "created_at", "recipient_region", "recipient_address", "parcel_value",
        "delivery_status",
    )


@query(
    """SELECT 'html' AS folder, 'html' AS format, CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages
UNION ALL SELECT 'names', 'unsupported', CAST(sum(strlen(n_name) + 1) AS BIGINT) FROM nation
UNION ALL SELECT 'tasks', 'task_metadata',
  CAST(sum(strlen('{"task_id":' || o_orderkey || ',"task_status":"' || o_orderstatus || '"}') + 1) AS BIGINT) FROM orders
UNION ALL SELECT 'export', 'csv', CAST(sum(strlen(l_orderkey || ',' || l_partkey) + 1) AS BIGINT) FROM lineitem"""
)
def file_format_audit(spark, sf_dir):
    folder = scratch_path(spark, "audit")
    table(spark, sf_dir, "pages").select("html").write.text(f"{folder}/html")
    table(spark, sf_dir, "nation").select("n_name").write.text(f"{folder}/names")
    task = F.struct(F.col("o_orderkey").alias("task_id"), F.col("o_orderstatus").alias("task_status"))
    table(spark, sf_dir, "orders").select(F.to_json(task)).write.text(f"{folder}/tasks")
    table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").write.csv(f"{folder}/export")
    files = exports.file_format_audit(spark, folder)
    return (
        files.select(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("folder"), "format", "length")
        .groupBy("folder", "format")
        .agg(F.sum("length").alias("bytes"))
    )


# ---------------------------------------------------------------- links and responses

HOST = "https://files.example.com"
PAGE_TOKENS = ["the", "de", "er"]


@query(
    f"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS u,
    generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) AS n FROM pages),
a AS (SELECT page_id, n, CASE WHEN lower(trim(u)) LIKE 'http://%' OR lower(trim(u)) LIKE 'https://%' THEN trim(u)
    WHEN trim(u) LIKE '/%' THEN '{HOST}' || trim(u) END AS link FROM h),
f AS (SELECT page_id, link, min(n) AS n FROM a
  WHERE lower(link) LIKE '%the%' OR lower(link) LIKE '%de%' OR lower(link) LIKE '%er%' GROUP BY page_id, link)
SELECT page_id, link, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS link_order FROM f"""
)
def link_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = links.extract_links(pages, links.hrefs(F.col("html")), HOST, PAGE_TOKENS)
    return found.select("page_id", "link", "link_order")


@query(
    f"""WITH s AS (
  SELECT page_id, 0 AS n, url || '/Export?id=' || page_id AS link FROM pages
  UNION ALL SELECT page_id, 1, '{HOST}/files/' || page_id || '.csv' FROM pages WHERE page_id % 2 = 0)
SELECT page_id, link, CAST(n AS INTEGER) AS link_order FROM s"""
)
def link_extract_json(spark, sf_dir):
    export_url = F.concat("url", F.lit("/Export?id="), "page_id")
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/files/"), "page_id", F.lit(".csv ")))
    payload = F.to_json(
        F.struct(
            F.struct(export_url.alias("self"), F.lit("export.csv").alias("name")).alias("download"),
            F.array(path, export_url, F.lit('say "/no"')).alias("links"),
            F.col("html").alias("body"),
        )
    )
    pages = table(spark, sf_dir, "pages").select("page_id", payload.alias("payload"))
    found = links.extract_links(pages, links.json_strings(F.col("payload")), HOST)
    return found.select("page_id", "link", "link_order")


RESOURCE = "CASE event_id % 5 WHEN 0 THEN 'fetch' WHEN 1 THEN 'image' WHEN 2 THEN '' WHEN 3 THEN 'XHR' ELSE 'document' END"
CONTENT_TYPE = """CASE event_id % 7 WHEN 0 THEN 'application/json' WHEN 1 THEN 'text/CSV; charset=utf-8'
  WHEN 2 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' WHEN 3 THEN 'application/vnd.ms-excel'
  WHEN 4 THEN CAST(NULL AS STRING) ELSE 'text/html' END"""
DISPOSITION = "CASE WHEN event_id % 11 = 0 THEN 'Attachment; filename=x' ELSE '' END"
RESPONSE_URL = """'https://host/' || event_type || CASE event_id % 6 WHEN 0 THEN '/task/1' WHEN 1 THEN '/Export/2'
  WHEN 2 THEN '/f.XLS' WHEN 3 THEN '/f.xlsx' WHEN 4 THEN '/f.csv' ELSE '/page' END"""


@query(
    f"""WITH log AS (SELECT event_id, lower({RESOURCE}) AS r, lower(coalesce({CONTENT_TYPE}, '')) AS t,
  lower({DISPOSITION}) AS d, lower({RESPONSE_URL}) AS u FROM events)
SELECT event_id,
  CASE WHEN t LIKE '%csv%' OR u LIKE '%.csv' THEN '.csv'
       WHEN t LIKE '%spreadsheetml%' OR t LIKE '%excel%' OR u LIKE '%.xlsx' THEN '.xlsx'
       WHEN u LIKE '%.xls' THEN '.xls' ELSE '.xlsx' END AS extension,
  CAST(CASE WHEN r = 'image' OR t LIKE '%json%' OR u LIKE '%/task%' THEN 0
       WHEN d LIKE '%attachment%' OR t LIKE '%spreadsheet%' OR t LIKE '%excel%' OR t LIKE '%csv%'
         OR u LIKE '%/export%' OR u LIKE '%.xls%' OR u LIKE '%.csv%' THEN 1 ELSE 0 END AS INTEGER) AS is_export
FROM log"""
)
def export_classify(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(RESOURCE).alias("resource_type"),
        F.expr(CONTENT_TYPE).alias("content_type"),
        F.expr(DISPOSITION).alias("disposition"),
        F.expr(RESPONSE_URL).alias("url"),
    )
    parts = [F.col(c) for c in ("resource_type", "content_type", "disposition", "url")]
    return log.select(
        "event_id",
        links.export_extension(parts[1], parts[3]).alias("extension"),
        links.is_export(*parts).alias("is_export"),
    )


# ---------------------------------------------------------------- normalised orders


def normalized(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return normalize.export_normalize(shipments(spark, sf_dir, lines=lines, part_first=True))


@query(
    f"""{NORM_CTE} SELECT {EXPORT_COLUMNS.replace('service_type', 'service_raw AS service_type')} FROM norm"""
)
def export_normalize(spark, sf_dir):
    return plain(normalized(spark, sf_dir))


@query(f"{NORM_CTE} SELECT {EXPORT_COLUMNS} FROM norm")
def order_safety_pass(spark, sf_dir):
    """The raw layer's way: records as JSON in an envelope, landed, read back, passed."""
    path = scratch_path(spark, "envelopes")
    orders = normalized(spark, sf_dir)
    record = F.to_json(F.struct(*orders.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"})
    envelope = F.concat(
        F.lit(f'{{"source_mode":"{SOURCE_EXPORT}","data":['), record, F.lit("]}")
    )
    run_ts = F.lit("2026-01-05 01:00:00").cast("timestamp")
    payloads.land_raw(
        orders.select(
            run_ts.alias("run_ts"),
            F.lit(SOURCE_EXPORT).alias("source"),
            F.col("customer_reference_no").cast("long").alias("page"),
            envelope.alias("payload"),
        ),
        path,
    )
    newest = payloads.latest_payload(payloads.read_raw(spark, path), SOURCE_EXPORT)
    return plain(build.orders_from_envelopes(newest))


UNION_COLUMNS = (
    "source_system, order_id, return_flag, return_reason, delivery_status, failed_reason, delay_reason"
)


@query(
    f"""WITH {SHIP}, {RULED}, {NORM}, {API1}, {API2}
SELECT source_system, order_id, CAST(return_flag AS INTEGER) AS return_flag, return_reason, delivery_status, failed_reason, delay_reason FROM norm
UNION ALL SELECT source_system, order_id, CAST(return_flag AS INTEGER), return_reason, '', '', '' FROM api1_norm
UNION ALL SELECT source_system, order_id, CAST(return_flag AS INTEGER), return_reason, '', '', '' FROM api2_norm"""
)
def source_union(spark, sf_dir):
    """The three sources, made of lines that are joined once."""
    bucketed = source_lines(spark, sf_dir)
    lines = bucketed.rows
    api1 = payloads.payload_explode(api1_pages(spark, sf_dir, lines), payloads.API1_ORDER)
    api2 = payloads.payload_explode(api2_pages(spark, sf_dir, lines), payloads.API2_ORDER)
    union = normalize.source_union(
        normalized(spark, sf_dir, lines),
        normalize.api1_normalize(api1),
        normalize.api2_normalize(api2),
    )
    bucketed.forget()
    return union.select(*UNION_COLUMNS.split(", "))


@query(
    f"""{NORM_CTE} SELECT order_id, CAST(is_cancelled AS INTEGER) AS is_cancelled,
  CAST(is_final_status AS INTEGER) AS is_final_status, CAST(eligible AS INTEGER) AS eligible_shipment_flag FROM norm"""
)
def eligibility_flags(spark, sf_dir):
    flagged = eligibility.eligibility_flags(normalized(spark, sf_dir))
    return flagged.select(
        "order_id", "is_cancelled", "is_final_status", "eligible_shipment_flag"
    )


@query(
    f"""{NORM_CTE} SELECT order_id, CAST(return_flag AS INTEGER) AS return_flag, return_reason, delivery_status
FROM norm WHERE eligible = 1"""
)
def eligible_orders(spark, sf_dir):
    flagged = eligibility.eligibility_flags(normalized(spark, sf_dir))
    return eligibility.eligible_orders(flagged).select(
        "order_id", "return_flag", "return_reason", "delivery_status"
    )


@query(
    f"""{NORM_CTE} SELECT {EXPORT_COLUMNS.replace('failed_reason, delay_reason',
        "nullif(failed_reason, '') AS failed_reason, nullif(delay_reason, '') AS delay_reason")},
  CAST(is_cancelled AS INTEGER) AS is_cancelled, CAST(is_final_status AS INTEGER) AS is_final_status,
  CAST(eligible AS INTEGER) AS eligible_shipment_flag FROM norm"""
)
def staging_orders(spark, sf_dir):
    path = scratch_path(spark, "staging")
    passed = normalize.order_safety_pass(normalized(spark, sf_dir))
    tables.write_staging(eligibility.eligibility_flags(passed), path)
    return plain(tables.read_staging(spark, path))


@query(
    f"""{NORM_CTE} SELECT order_id, CAST(event_date AS VARCHAR) AS event_date, province, cod_type,
  CAST(order_value AS DOUBLE) AS order_value, CAST(return_flag AS INTEGER) AS return_flag, return_reason FROM norm"""
)
def records_json(spark, sf_dir):
    path = scratch_path(spark, "records")
    normalized(spark, sf_dir).write.json(path, compression="gzip")
    back = spark.read.schema(EXPORT_ORDER).json(path)
    names = "order_id event_date province cod_type order_value return_flag return_reason".split()
    return plain(back.select(*names))


