"""Common parts of the oracle queries, in DuckDB's SQL.

They state the expected rows from the tables themselves: dates come from the date
columns and money from the number columns, not from the texts that Spark has to parse.
"""

# The texts of the export rows, for oracles of rules that read texts.
SHIP = """
ship AS (
  SELECT l.*, o.o_orderdate, o.o_orderstatus, o.o_orderpriority, c.c_mktsegment, n.n_name, r.r_name,
    p.p_type, s.s_name,
    'L' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS tracking_no,
    CAST(l_orderkey AS VARCHAR) AS customer_reference_no,
    CASE WHEN l_linenumber = 5 AND l_orderkey % 50 = 0 THEN ''
         WHEN l_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
         WHEN l_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(o_orderdate, '%d-%m-%Y %H:%M') END AS created_text,
    CASE WHEN l_linenumber = 5 AND l_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS event_date,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'COD' WHEN 'MACHINERY' THEN 'Non-COD'
         WHEN 'HOUSEHOLD' THEN '' WHEN 'FURNITURE' THEN 'nan' ELSE 'Sender Pay' END AS payment_role,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Y' WHEN '2-HIGH' THEN 'yes' ELSE 'N' END AS cod_flag,
    format('{:,.2f}', l_extendedprice) AS parcel_text,
    CASE l_linenumber WHEN 1 THEN 'Receiver refused' WHEN 2 THEN 'Address not found'
         WHEN 7 THEN 'Dibatalkan pembeli' ELSE '' END AS failed_reason,
    CASE WHEN l_linenumber = 3 THEN 'Bad weather' ELSE '' END AS delay_reason,
    CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') ELSE '' END AS returned_text,
    CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN 'Returned' ELSE 'Returning' END
         WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'F' THEN 'Delivered'
              WHEN o_orderstatus = 'P' THEN 'On Hold' WHEN o_orderstatus = 'O' THEN 'Delivery Failed' ELSE 'Lost' END
         WHEN l_linestatus = 'F' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 'Damaged' ELSE 'DELIVERED' END
         ELSE CASE WHEN o_orderstatus = 'F' THEN 'Cancelled' ELSE 'Delivering' END END AS delivery_status
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey
    JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey
    JOIN part p ON l_partkey = p_partkey JOIN supplier s ON l_suppkey = s_suppkey
)"""

# Rule, flag and reason of each row, from the status and reason texts.
RULED = """
ruled AS (
  SELECT *, lower(delivery_status) AS low,
    lower(delivery_status || ' ' || failed_reason || ' ' || delay_reason) AS words,
    CASE WHEN words LIKE '%cancel%' OR words LIKE '%batal%' THEN 1
         WHEN low = 'delivered' THEN 2
         WHEN returned_text <> '' OR low IN ('returned', 'returning') THEN 3
         WHEN low IN ('damaged', 'lost') THEN 4
         WHEN failed_reason <> '' AND low NOT IN ('in transit', 'delivering', 'pickup on hold', 'on hold') THEN 5
         WHEN failed_reason <> '' THEN 6 ELSE 7 END AS rule
  FROM ship
)"""

# Normalised export orders.
NORM = """
norm AS (
  SELECT tracking_no, s_name, 'spx_web' AS source_system, tracking_no AS order_id, event_date,
    r_name AS province, n_name AS city, 'SPX' AS expedition,
    CASE WHEN p_type = 'SMALL' THEN o_orderpriority ELSE p_type END AS service_raw,
    CASE service_raw WHEN 'ECONOMY' THEN 'Eco' WHEN 'STANDARD' THEN 'Standard' ELSE service_raw END AS service_type,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'COD' WHEN 'MACHINERY' THEN 'Non-COD'
         WHEN 'AUTOMOBILE' THEN 'Sender Pay' ELSE 'No Value' END AS payment_method,
    CASE WHEN (c_mktsegment = 'BUILDING' AND l_extendedprice > 0) OR o_orderpriority IN ('1-URGENT', '2-HIGH')
         THEN 'COD' ELSE 'NON-COD' END AS cod_type,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS order_value,
    CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS cod_value,
    CASE WHEN l_linenumber = 4 OR l_quantity <= 0 THEN CAST(l_discount AS DECIMAL(18,2))
         ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS shipping_fee,
    CASE WHEN rule IN (3, 4, 5) THEN 1 ELSE 0 END AS return_flag,
    CASE rule WHEN 1 THEN 'Cancelled' WHEN 2 THEN 'No Reason Provided' WHEN 7 THEN 'No Reason Provided'
         WHEN 5 THEN failed_reason WHEN 6 THEN failed_reason
         ELSE coalesce(nullif(failed_reason, ''), nullif(delay_reason, ''), delivery_status) END AS return_reason,
    customer_reference_no, delivery_status, failed_reason, delay_reason,
    CAST(event_date AS TIMESTAMP) AS created_at,
    CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS returned_at,
    CASE WHEN rule = 1 THEN 1 ELSE 0 END AS is_cancelled,
    CASE WHEN low IN ('delivered', 'returned', 'damaged', 'lost') THEN 1 ELSE 0 END AS is_final_status,
    CASE WHEN rule <> 1 AND low IN ('delivered', 'returned', 'damaged', 'lost') THEN 1 ELSE 0 END AS eligible
  FROM ruled
)"""

SHIP_CTE = f"WITH {SHIP}"
RULED_CTE = f"WITH {SHIP}, {RULED}"
NORM_CTE = f"WITH {SHIP}, {RULED}, {NORM}"


def eligible_cte(where: str = "true", carrier: str = "s_name") -> str:
    """Eligible orders with week keys and the carrier."""
    return f"""{NORM_CTE}, eligible AS (
  SELECT * REPLACE ({carrier} AS expedition), CAST(year(event_date) AS INTEGER) AS year,
    CAST(week(event_date) AS INTEGER) AS week_of_year
  FROM norm WHERE eligible = 1 AND ({where})
)"""


GROUP = "year, week_of_year, province, city, expedition"


def weekly_sql(source: str = "eligible") -> str:
    return f"""
  SELECT {GROUP}, service_type, payment_method, cod_type,
    count(order_id) AS total_shipments, CAST(sum(return_flag) AS BIGINT) AS total_returns,
    CAST(sum(order_value) AS DOUBLE) AS total_order_value, CAST(sum(cod_value) AS DOUBLE) AS total_cod_value,
    CAST(sum(shipping_fee) AS DOUBLE) AS total_shipping_fee,
    CAST(sum(return_flag) AS DOUBLE) / CAST(count(order_id) AS DOUBLE) AS return_rate
  FROM {source} GROUP BY {GROUP}, service_type, payment_method, cod_type"""


def reason_sql(source: str = "eligible") -> str:
    return f"""
  SELECT {GROUP}, service_type, return_reason,
    count(order_id) AS total_shipments, CAST(sum(return_flag) AS BIGINT) AS total_returns,
    CAST(sum(return_flag) AS DOUBLE) / CAST(count(order_id) AS DOUBLE) AS return_rate
  FROM {source} GROUP BY {GROUP}, service_type, return_reason"""


def driver_sql(drivers: list[str] = ("service_type",), source: str = "eligible") -> str:
    frames = " UNION ALL ".join(
        f"""SELECT {GROUP}, '{d}' AS driver_type, {d} AS driver_value,
      count(order_id) AS total_shipments, CAST(sum(return_flag) AS BIGINT) AS total_returns,
      CAST(sum(order_value) AS DOUBLE) AS total_order_value,
      CAST(sum(return_flag) AS DOUBLE) / CAST(count(order_id) AS DOUBLE) AS return_rate
    FROM {source} GROUP BY {GROUP}, {d}"""
        for d in drivers
    )
    return f"""
  SELECT {GROUP}, driver_type, driver_value, total_shipments, total_returns, total_order_value,
    CAST(total_shipments AS DOUBLE)
      / CAST(sum(total_shipments) OVER (PARTITION BY {GROUP}, driver_type) AS DOUBLE) AS shipments_share,
    return_rate,
    CAST(dense_rank() OVER (PARTITION BY {GROUP}, driver_type ORDER BY return_rate DESC) AS INTEGER) AS rank_in_group
  FROM ({frames})"""


# Expected rows of the two order APIs, from the tables.
API1 = """
api1 AS (
  SELECT *,
    CASE WHEN l_linenumber = 3 THEN 'Gagal antar' WHEN l_linenumber = 1 THEN 'RETUR'
         WHEN l_linenumber = 2 THEN 'In process return' ELSE delivery_status END AS status,
    CASE WHEN l_linenumber IN (1, 3) THEN 1
         WHEN l_linenumber = 2 THEN 0
         WHEN delivery_status IN ('Returned', 'Returning') THEN 1 ELSE 0 END AS returned,
    CASE WHEN l_linenumber = 2 AND o_orderpriority = '1-URGENT' THEN l_extendedprice ELSE 0 END AS cod
  FROM ship
), api1_norm AS (
  SELECT 'api1' AS source_system,
    CASE WHEN l_linenumber = 6 THEN 'S' || tracking_no ELSE tracking_no END AS order_id,
    CAST(o_orderdate AS DATE) AS event_date, r_name AS province,
    CASE WHEN l_linenumber = 1 THEN 'No Value' ELSE n_name END AS city,
    CASE WHEN l_linenumber = 7 THEN 'Courier house' ELSE 'Carrier ' || (l_suppkey % 5) END AS expedition,
    CASE p_type WHEN 'ECONOMY' THEN 'Eco' WHEN 'STANDARD' THEN 'Standard' ELSE p_type END AS service_type,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'RTS pay' ELSE c_mktsegment END AS payment_method,
    CASE WHEN c_mktsegment = 'BUILDING' OR cod > 0 THEN 'COD' ELSE 'NON-COD' END AS cod_type,
    CAST(CASE WHEN l_linenumber <> 7 THEN l_extendedprice WHEN l_orderkey % 2 = 0 THEN 1250.5
         ELSE l_quantity END AS DECIMAL(18,2)) AS order_value,
    CAST(cod AS DECIMAL(18,2)) AS cod_value,
    CAST(CASE WHEN l_linenumber = 1 OR l_discount = 0 THEN l_quantity ELSE l_discount END AS DECIMAL(18,2)) AS shipping_fee,
    returned AS return_flag,
    CASE WHEN returned = 0 OR status = 'RETUR' THEN 'No Reason Provided' ELSE status END AS return_reason
  FROM api1
)"""

API2 = """
api2 AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
    CASE WHEN c_mktsegment = 'BUILDING' THEN l_extendedprice ELSE 0 END AS cod_amount,
    CASE WHEN o_orderpriority = '1-URGENT' THEN l_discount ELSE 0 END AS service_fee,
    CASE l_linenumber WHEN 1 THEN 'Reason Code 11' WHEN 2 THEN 'No Value' WHEN 3 THEN 'No Reason Provided'
         WHEN 4 THEN 'Bad address' WHEN 5 THEN 'No Reason Provided' ELSE 'Reason Code 404' END AS reason
  FROM ship
), api2_norm AS (
  SELECT 'api2' AS source_system,
    CASE WHEN l_linenumber = 2 THEN customer_reference_no ELSE tracking_no END AS order_id,
    CAST(o_orderdate AS DATE) AS event_date, r_name AS province, n_name AS city,
    CASE WHEN l_linenumber = 1 THEN 'SPX' ELSE 'Partner' END AS expedition,
    CASE p_type WHEN 'ECONOMY' THEN 'Eco' WHEN 'STANDARD' THEN 'Standard' ELSE p_type END AS service_type,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown' ELSE c_mktsegment END AS payment_method,
    CASE WHEN service_fee > 0 OR cod_amount > 0 THEN 'COD' ELSE 'NON-COD' END AS cod_type,
    CAST(CASE WHEN l_linenumber <> 4 THEN l_quantity
              WHEN l_orderkey % 2 = 0 AND l_tax > 0 THEN l_tax ELSE cod_amount END AS DECIMAL(18,2)) AS order_value,
    CAST(CASE WHEN cod_amount > 0 THEN cod_amount ELSE service_fee END AS DECIMAL(18,2)) AS cod_value,
    CAST(CASE WHEN l_linenumber = 4 THEN 0 ELSE l_quantity END AS DECIMAL(18,2)) AS shipping_fee,
    returned AS return_flag,
    CASE WHEN returned = 1 THEN reason ELSE 'No Reason Provided' END AS return_reason
  FROM api2
)"""

ORDER_COLUMNS = """source_system, order_id, CAST(event_date AS VARCHAR) AS event_date, province, city,
  expedition, service_type, payment_method, cod_type, CAST(order_value AS DOUBLE) AS order_value,
  CAST(cod_value AS DOUBLE) AS cod_value, CAST(shipping_fee AS DOUBLE) AS shipping_fee,
  CAST(return_flag AS INTEGER) AS return_flag, return_reason"""

EXPORT_COLUMNS = ORDER_COLUMNS + """, customer_reference_no, delivery_status, failed_reason, delay_reason,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
  strftime(returned_at, '%Y-%m-%d %H:%M:%S') AS returned_to_sender_at"""


def all_marts_sql(source: str = "eligible") -> str:
    """The rows of all three marts, named; columns that a mart lacks are null."""
    parts = [
        ("fact_returns_weekly", weekly_sql(source)),
        ("fact_return_reason_weekly", reason_sql(source)),
        ("fact_return_driver_weekly", driver_sql(source=source)),
    ]
    return " UNION ALL BY NAME ".join(f"SELECT '{name}' AS mart, * FROM ({sql})" for name, sql in parts)
