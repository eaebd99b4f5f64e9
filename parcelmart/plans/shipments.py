"""Courier data made from the star-schema test tables: one export row per line item.

Every field is a Spark SQL expression over the tables; only the tables that the wanted
fields need are joined. The oracles hold the same mapping in their own SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.operators.buckets import Bucketed, write_buckets
from parcelmart.schemas import EXPORT_FIELDS

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]

PARCEL_VALUE = "format_number(l_extendedprice, 2)"

# field: (SQL expression, tables it needs besides lineitem)
FIELDS = {
    "tracking_no": (
        "concat('L', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)",
        [],
    ),
    "customer_reference_no": ("cast(l_orderkey as string)", []),
    "created_at": (
        """CASE WHEN l_linenumber = 5 AND l_orderkey % 50 = 0 THEN ''
                WHEN l_orderkey % 3 = 0 THEN date_format(o_orderdate, 'dd/MM/yyyy')
                WHEN l_orderkey % 3 = 1 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
                ELSE date_format(o_orderdate, 'dd-MM-yyyy HH:mm') END""",
        ["orders"],
    ),
    "recipient_name": ("'Recipient'", []),
    "recipient_phone": ("''", []),
    "recipient_region": ("concat(r_name, ' / ', n_name, ' / ', c_mktsegment)", ["orders", "customer"]),
    "recipient_address": ("concat('Street ', l_suppkey, ', \"Block\" ', l_linenumber)", []),
    "pickup_region": ("''", []),
    "pickup_address": ("''", []),
    "scheduled_pickup_at": ("''", []),
    "actual_pickup_at": ("''", []),
    "delivered_at": ("''", []),
    "payment_role": (
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'COD' WHEN 'MACHINERY' THEN 'Non-COD'
                WHEN 'HOUSEHOLD' THEN '' WHEN 'FURNITURE' THEN 'nan' ELSE 'Sender Pay' END""",
        ["orders", "customer"],
    ),
    "original_pickup_option": ("CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END", ["part"]),
    "actual_pickup_option": ("o_orderpriority", ["orders"]),
    "cod_collection_flag": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Y' WHEN '2-HIGH' THEN 'yes' ELSE 'N' END",
        ["orders"],
    ),
    "cod_amount": (
        f"CASE WHEN c_mktsegment = 'BUILDING' THEN {PARCEL_VALUE} ELSE '' END",
        ["orders", "customer"],
    ),
    "parcel_value": (PARCEL_VALUE, []),
    "estimated_shipping_fee": ("cast(cast(l_discount as decimal(18,2)) as string)", []),
    "actual_shipping_fee": (
        "CASE WHEN l_linenumber = 4 THEN '-' ELSE cast(cast(l_quantity as decimal(18,2)) as string) END",
        [],
    ),
    "delayed_at": ("''", []),
    "delay_reason": ("CASE WHEN l_linenumber = 3 THEN 'Bad weather' ELSE '' END", []),
    "returned_to_sender_at": (
        "CASE WHEN l_returnflag = 'R' THEN date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') ELSE '' END",
        [],
    ),
    "failed_reason": (
        """CASE l_linenumber WHEN 1 THEN 'Receiver refused' WHEN 2 THEN 'Address not found'
                WHEN 7 THEN 'Dibatalkan pembeli' ELSE '' END""",
        [],
    ),
    "creation_method": ("'manual'", []),
    "created_by": ("'owner'", []),
    "delivery_status": (
        """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Returned'
                WHEN l_returnflag = 'R' THEN 'Returning'
                WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Delivered'
                WHEN l_returnflag = 'A' THEN CASE o_orderstatus WHEN 'P' THEN 'On Hold'
                     WHEN 'O' THEN 'Delivery Failed' ELSE 'Lost' END
                WHEN l_linestatus = 'F' THEN
                     CASE WHEN o_orderpriority = '5-LOW' THEN 'Damaged' ELSE 'DELIVERED' END
                WHEN o_orderstatus = 'F' THEN 'Cancelled' ELSE 'Delivering' END""",
        ["orders"],
    ),
    # Besides the export fields:
    "carrier": ("s_name", ["supplier"]),
    "order_ts": ("o_orderdate", ["orders"]),
    "segment": ("c_mktsegment", ["orders", "customer"]),
    "priority": ("o_orderpriority", ["orders"]),
    "province_name": ("r_name", ["orders", "customer"]),
    "city_name": ("n_name", ["orders", "customer"]),
    "part_type": ("p_type", ["part"]),
}


SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from a file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def line_items(spark: SparkSession, sf_dir: str, tables: list[str], part_first: bool = False) -> DataFrame:
    """Line items joined with the given tables, each on its unique key. Parts come after orders, since
    filters on orders come before them; ``part_first`` is for rows that are all kept: they then meet
    parts while they are narrow.

    Line items and orders are both large, so they are merged: broadcasting one of them,
    as Spark would on small test tables, would also leave all later work to the few
    input splits of the other. Hot order or part keys are split by the adaptive skew
    join."""
    lines = table(spark, sf_dir, "lineitem")

    def with_parts(rows: DataFrame) -> DataFrame:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        return rows.join(part, F.col("l_partkey") == F.col("p_partkey"))

    if "part" in tables and part_first:
        lines = with_parts(lines)
    if "orders" in tables:
        orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
        if "customer" in tables:
            region = table(spark, sf_dir, "region")
            nation = table(spark, sf_dir, "nation").join(
                region, F.col("n_regionkey") == F.col("r_regionkey")
            )
            customer = table(spark, sf_dir, "customer").join(
                nation, F.col("c_nationkey") == F.col("n_nationkey")
            )
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        lines = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in tables and not part_first:
        lines = with_parts(lines)
    if "supplier" in tables:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines


def shipments(
    spark: SparkSession,
    sf_dir: str,
    fields: list[str] = EXPORT_FIELDS,
    keys: bool = False,
    lines: DataFrame | None = None,
    part_first: bool = False,
) -> DataFrame:
    """The given fields of every shipment, with the line item's keys if wanted; of ``lines`` if
    they are joined already. ``part_first`` as for ``line_items``."""
    rows = lines if lines is not None else line_items(spark, sf_dir, tables_of(fields), part_first)
    columns = [F.expr(FIELDS[f][0]).alias(f) for f in fields]
    return rows.select(*(KEYS if keys else []), *columns)


def tables_of(fields: list[str]) -> list[str]:
    return sorted({t for f in fields for t in FIELDS[f][1]})


CARRIER_FIELDS = EXPORT_FIELDS + ["carrier"]


def carrier_shipments(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, part_first: bool = False
) -> DataFrame:
    """Export rows with the supplier as carrier, so that marts have many expeditions."""
    return shipments(spark, sf_dir, CARRIER_FIELDS, lines=lines, part_first=part_first)


# ---------------------------------------------------------------- JSON pages

# Shapes of the two order APIs, over shipment fields; numbers stay JSON numbers and
# some values are left out or doubled, so that every fallback is met.
API1_FIELDS = [
    "tracking_no", "customer_reference_no", "order_ts", "segment", "priority",
    "province_name", "city_name", "delivery_status", "part_type",
]
API1_JSON = """
named_struct(
  'awb_number', CASE WHEN l_linenumber = 6 THEN '' ELSE tracking_no END,
  'shipment_order_no', concat('S', tracking_no),
  'created_at', CASE WHEN l_linenumber = 5 THEN 'soon' WHEN l_linenumber = 4 THEN NULL
                     ELSE date_format(order_ts, 'yyyy-MM-dd HH:mm:ss') END,
  'status_name', CASE WHEN l_linenumber = 3 THEN 'Gagal antar' ELSE 'Delivered' END,
  'is_cod', segment = 'BUILDING',
  'cod', CASE WHEN l_linenumber = 2 THEN NULL ELSE 0 END,
  'total', l_quantity,
  'payment_method', CASE WHEN segment = 'HOUSEHOLD' THEN NULL ELSE segment END,
  'shipment', named_struct(
     'status_name', CASE WHEN l_linenumber = 3 THEN '' WHEN l_linenumber = 1 THEN 'RETUR'
                         WHEN l_linenumber = 2 THEN 'In process return' ELSE delivery_status END,
     'pickup_time_date', CASE WHEN l_linenumber = 4 THEN unix_seconds(cast(order_ts as timestamp)) END,
     'pickup_time', date_format(order_ts, "yyyy-MM-dd'T'HH:mm:ss"),
     'cod', CASE WHEN priority = '1-URGENT' THEN l_extendedprice ELSE 0 END,
     'payment_method_rts', 'RTS pay',
     'total_price', CASE WHEN l_linenumber = 7 THEN 0 ELSE l_extendedprice END,
     'total', CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN '1,250.50' END,
     'fee', CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END,
     'shipping_fee', l_quantity,
     'logistic_name', 'Courier house',
     'logistic', named_struct('rate_name', part_type)),
  'logistic', CASE WHEN l_linenumber = 7 THEN from_json('{}', 'name string, rate_type_name string')
                   ELSE named_struct('name', concat('Carrier ', l_suppkey % 5),
                                     'rate_type_name', part_type) END,
  'receiver', named_struct('address_detail', named_struct(
     'province', province_name, 'city', CASE WHEN l_linenumber = 1 THEN '  ' ELSE city_name END)))
"""

API2_FIELDS = [
    "tracking_no", "customer_reference_no", "order_ts", "segment", "priority",
    "province_name", "city_name", "part_type",
]
API2_JSON = """
named_struct(
  'cod_amount', CASE WHEN segment = 'BUILDING' THEN l_extendedprice ELSE 0 END,
  'base_info', named_struct('three_pl_name', CASE WHEN l_linenumber = 1 THEN '' ELSE 'Partner' END,
                            'product_name', part_type),
  'order_info', named_struct('order_sn', CASE WHEN l_linenumber = 2 THEN NULL ELSE tracking_no END,
                             'order_id', customer_reference_no,
                             'ctime', unix_seconds(cast(order_ts as timestamp))),
  'deliver_info', named_struct('deliver_state', province_name, 'deliver_city', city_name),
  'tracking_info', named_struct(
     'returning_start_time', CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 1500000000 ELSE 0 END,
     'returned_time', CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1500000000 END,
     'latest_tracking_reason', CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN NULL WHEN 3 THEN 'unknown'
                                    WHEN 4 THEN ' Bad address ' WHEN 5 THEN '' ELSE '404' END,
     'reason_code', CASE l_linenumber WHEN 2 THEN NULL WHEN 5 THEN 0 ELSE l_linenumber + 10 END),
  'finance_info', named_struct(
     'cod_service_fee', CASE WHEN priority = '1-URGENT' THEN l_discount ELSE 0 END,
     'actual_shipping_fee', CASE WHEN l_linenumber = 4 THEN 0 ELSE l_quantity END,
     'estimated_shipping_fee', CASE WHEN l_linenumber = 4 AND l_orderkey % 2 = 0 THEN l_tax END),
  'fulfillment_info', CASE WHEN segment = 'HOUSEHOLD' THEN NULL
                           ELSE named_struct('payment_method_rts', segment) END)
"""

LINE_COLUMNS = KEYS + [
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
PAGE_ORDERS = 100


SOURCE_COLUMNS = LINE_COLUMNS + [
    "l_shipdate", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_mktsegment", "r_name", "n_name", "p_type",
]


def export_lines(spark: SparkSession, sf_dir: str, fields: list[str] = EXPORT_FIELDS) -> DataFrame:
    """The joined lines, with only the columns that the given fields are made of: less than half as wide as the
    fields, for rows that are moved before these are made."""
    lines = line_items(spark, sf_dir, tables_of(fields), part_first=True)
    kept = SOURCE_COLUMNS + ["s_name"]
    return lines.select(*[c for c in lines.columns if c in kept and c != "l_tax"])


def paged(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines with the page that their order is on.

    Orders are spread over the pages by a hash of the whole line item, so pages stay
    small whatever keys are hot, and a repeated task builds the same pages."""
    n_pages = max(1, table(spark, sf_dir, "lineitem").count() // PAGE_ORDERS)
    return lines.withColumn("page", F.pmod(F.xxhash64(*LINE_COLUMNS), F.lit(n_pages)))


def source_lines(spark: SparkSession, sf_dir: str) -> Bucketed:
    """The joined lines that all three sources are made of, as a table bucketed by page: they are joined
    once, and neither API's pages shuffle them again."""
    lines = paged(spark, sf_dir, line_items(spark, sf_dir, tables_of(EXPORT_FIELDS + API1_FIELDS + API2_FIELDS), part_first=True))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return write_buckets(lines.select("page", *SOURCE_COLUMNS), "page", buckets, "source_lines")


def json_pages(
    spark: SparkSession, sf_dir: str, fields: list[str], shape: str, list_name: str, lines: DataFrame | None = None
) -> DataFrame:
    """(page, payload): pages of about 100 orders, one nested JSON order per line item. ``lines`` are those of
    ``source_lines``; else the tables are joined, and lines are moved to their page before they
    become JSON, which is wider."""
    if lines is None:
        lines = paged(spark, sf_dir, line_items(spark, sf_dir, tables_of(fields), part_first=True)).repartition("page")
    named = lines.select("page", *LINE_COLUMNS, *[F.expr(FIELDS[f][0]).alias(f) for f in fields])
    orders = named.select("page", F.to_json(F.expr(shape)).alias("order_json"))
    listed = F.array_join(F.collect_list("order_json"), ",")
    payload = F.concat(F.lit(f'{{"data":{{"data":{{"{list_name}":['), listed, F.lit("]}}}"))
    return orders.groupBy("page").agg(payload.alias("payload"))


def api1_pages(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return json_pages(spark, sf_dir, API1_FIELDS, API1_JSON, "orders", lines)


def api2_pages(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return json_pages(spark, sf_dir, API2_FIELDS, API2_JSON, "list", lines)
