"""Column names, fixed values and table schemas shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Results depend on these exact texts.
# --------------------------------------------------------------------------
NO_VALUE = "No Value"
NO_REASON = "No Reason Provided"
CANCELLED = "Cancelled"
COD = "COD"
NON_COD = "NON-COD"
EXPORT_EXPEDITION = "SPX"

SOURCE_API1 = "api1"
SOURCE_API2 = "api2"
SOURCE_EXPORT = "spx_web"
DEFAULT_MODE = "api"

NULL_WORDS = ["nan", "nat", "none", "null"]
CANCEL_WORDS = ["cancel", "canceled", "cancelled", "batal", "dibatalkan"]
COD_FLAG_WORDS = ["y", "yes", "cod", "true"]

STATUS_DELIVERED = ["delivered"]
STATUS_RETURN = ["returned", "returning"]
STATUS_LOSS = ["damaged", "lost"]
STATUS_IN_PROGRESS = ["in transit", "delivering", "pickup on hold", "on hold"]
STATUS_FINAL = ["delivered", "returned", "damaged", "lost"]

RETURN_WORDS = [
    "RETURN",
    "RETUR",
    "RTS",
    "RETURN TO SENDER",
    "RECEIVER REFUSED TO ACCEPT",
    "CANCELLED BY COURIER (REFUSED)",
    "DELIVERY FAILED - OUT OF DELIVERY ATTEMPTS",
    "RETURN - ITEM DAMAGED",
    "CONSIGNEE UNREACHABLE - RETURN",
    "GAGAL ANTAR",
    "DITOLAK",
]
NOT_RETURN_WORDS = [
    "IN PROCESS RETURN",
    "PEMBELI MENJADWALKAN ULANG WAKTU PENGIRIMAN",
    "PENJUAL BELUM SELESAI MENYIAPKAN PESANAN",
]

# Export fields and the headers a file may use for them, preferred header first.
EXPORT_HEADERS = {
    "tracking_no": ["Nomer Resi", "Tracking No."],
    "customer_reference_no": ["No Referensi Pelanggan", "Customer Reference No."],
    "created_at": ["Waktu dibuat", "Create Time"],
    "recipient_name": ["Nama Penerima", "Recipient Name"],
    "recipient_phone": ["Nomer Telepon Penerima", "Recipient Phone Number"],
    "recipient_region": ["Provinsi/Kota/Kecamatan Penerima"],
    "recipient_address": ["Alamat Detail Penerima", "Recipient Detail Address"],
    "pickup_region": ["Provinsi/Kota/Kecamatan Penjemputan"],
    "pickup_address": ["Alamat Detail Penjemputan", "Sender Detail Address"],
    "scheduled_pickup_at": ["Waktu Penjemputan Terjadwal", "Scheduled Pickup Time"],
    "actual_pickup_at": ["Waktu Penjemputan/Drop Off Aktual", "Actual Pickup/Drop Off Time"],
    "delivered_at": ["Waktu Terkirim", "Delivered Time"],
    "payment_role": ["Payment Role"],
    "original_pickup_option": ["Opsi Penjemputan Awal", "Original pickup option", "Original Pickup Option"],
    "actual_pickup_option": ["Opsi Penjemputan Aktual", "Actual pickup option"],
    "cod_collection_flag": ["Koleksi COD", "COD Collection(Y/N)"],
    "cod_amount": ["Jumlah COD", "COD Amount"],
    "parcel_value": ["Nilai Parcel", "Parcel Value"],
    "estimated_shipping_fee": ["Estimasi Ongkir", "Estimated Shipping Fee"],
    "actual_shipping_fee": ["Ongkir Aktual", "Actual Shipping Fee"],
    "delayed_at": ["Waktu Penundaan Pengiriman", "Delivery OnHold Times"],
    "delay_reason": ["Alasan Pengiriman Tertunda", "Delivery OnHold Reason"],
    "returned_to_sender_at": ["Waktu pengembalian ke pengirim", "Returning Start Time"],
    "failed_reason": ["Alasan pengiriman gagal", "Delivery failed Reason"],
    "creation_method": ["Metode Pembuatan", "Create Method"],
    "created_by": ["Dibuat oleh", "Order Creator"],
    "delivery_status": ["Status Pengiriman", "Tracking Status"],
}

# Region fields that some files split over three columns.
REGION_PARTS = {
    "recipient_region": ["Recipient Province", "Recipient City", "Recipient District"],
    "pickup_region": ["Sender Province", "Sender City", "Sender District"],
}

# A row with at least this many known headers in its cells is a header row.
HEADER_ROW_MIN_CELLS = 5

# Cells that a CSV reader with default settings takes as missing.
CSV_NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --------------------------------------------------------------------------
# Tables
# --------------------------------------------------------------------------
EXPORT_FIELDS = list(EXPORT_HEADERS)
KNOWN_HEADERS = sorted({header for headers in EXPORT_HEADERS.values() for header in headers})

MONEY = T.DecimalType(28, 6)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


NORMALIZED_ORDER = _struct(
    source_system=T.StringType(),
    order_id=T.StringType(),
    event_date=T.DateType(),
    province=T.StringType(),
    city=T.StringType(),
    expedition=T.StringType(),
    service_type=T.StringType(),
    payment_method=T.StringType(),
    cod_type=T.StringType(),
    order_value=MONEY,
    cod_value=MONEY,
    shipping_fee=MONEY,
    return_flag=T.IntegerType(),
    return_reason=T.StringType(),
)

EXPORT_ORDER = T.StructType(
    NORMALIZED_ORDER.fields
    + _struct(
        customer_reference_no=T.StringType(),
        delivery_status=T.StringType(),
        failed_reason=T.StringType(),
        delay_reason=T.StringType(),
        created_at=T.TimestampNTZType(),
        returned_to_sender_at=T.TimestampNTZType(),
    ).fields
)

STAGING_ORDER = T.StructType(
    EXPORT_ORDER.fields
    + _struct(
        is_cancelled=T.IntegerType(),
        is_final_status=T.IntegerType(),
        eligible_shipment_flag=T.IntegerType(),
    ).fields
)

# Texts an order row must have before the eligibility flags are computed.
BACKFILLED_COLUMNS = ["delivery_status", "return_reason", "failed_reason", "delay_reason"]

RAW_PAYLOAD = _struct(
    run_ts=T.TimestampType(),
    source=T.StringType(),
    page=T.LongType(),
    payload=T.StringType(),
)

WEEK_KEYS = ["year", "week_of_year"]
GROUP_KEYS = WEEK_KEYS + ["province", "city", "expedition"]
WEEKLY_KEYS = GROUP_KEYS + ["service_type", "payment_method", "cod_type"]
REASON_KEYS = GROUP_KEYS + ["service_type", "return_reason"]
DRIVER_KEYS = GROUP_KEYS + ["driver_type", "driver_value"]
BASE_KEYS = WEEKLY_KEYS + ["return_reason"]

_WEEK = dict(year=T.IntegerType(), week_of_year=T.IntegerType())
_GROUP = dict(_WEEK, province=T.StringType(), city=T.StringType(), expedition=T.StringType())
_COUNTS = dict(total_shipments=T.LongType(), total_returns=T.LongType())

FACT_WEEKLY = _struct(
    **_GROUP,
    service_type=T.StringType(),
    payment_method=T.StringType(),
    cod_type=T.StringType(),
    **_COUNTS,
    total_order_value=T.DoubleType(),
    total_cod_value=T.DoubleType(),
    total_shipping_fee=T.DoubleType(),
    return_rate=T.DoubleType(),
)

FACT_REASON = _struct(
    **_GROUP,
    service_type=T.StringType(),
    return_reason=T.StringType(),
    **_COUNTS,
    return_rate=T.DoubleType(),
)

FACT_DRIVER = _struct(
    **_GROUP,
    driver_type=T.StringType(),
    driver_value=T.StringType(),
    **_COUNTS,
    total_order_value=T.DoubleType(),
    shipments_share=T.DoubleType(),
    return_rate=T.DoubleType(),
    rank_in_group=T.IntegerType(),
)

MARTS = {
    "fact_returns_weekly": (FACT_WEEKLY, WEEKLY_KEYS),
    "fact_return_reason_weekly": (FACT_REASON, REASON_KEYS),
    "fact_return_driver_weekly": (FACT_DRIVER, DRIVER_KEYS),
}
