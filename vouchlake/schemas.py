"""Table schemas, keys and the fixed texts stored in the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _table(columns: str) -> StructType:
    """A schema from ``name type`` pairs; needs no running session."""
    schema = StructType()
    for column in columns.split(","):
        schema.add(*column.split())
    return schema


# The columns of the landing CSVs. All are text, taken by position.
STAGE = {
    "customers": _table("customer_id string, customer_name string, email string, phone string, created_date string, country string"),
    "orders": _table(
        "order_id string, customer_id string, order_date string, order_status string, "
        "order_total string, source_updated_at string"
    ),
    "order_items": _table("order_item_id string, order_id string, product_id string, product_name string, quantity string, unit_price string"),
    "payments": _table("payment_id string, order_id string, payment_date string, payment_method string, amount string, payment_status string"),
    "returns": _table("return_id string, order_id string, return_date string, reason string, refund_amount string"),
    "pdf_manifest": _table("file_name string, order_id string, document_type string, created_date string"),
}

STAGE_FILES = {table: f"{table}.csv" for table in STAGE}

# The business key of each table is the first column of its file.
KEYS = {table: schema.fieldNames()[0] for table, schema in STAGE.items()}


def _raw(table: str) -> StructType:
    schema = StructType(list(STAGE[table].fields))
    if table == "orders":
        schema = schema.add("row_status", "string")
    return schema.add("ingestion_time", "timestamp").add("source_file", "string")


RAW = {f"{table}_raw": _raw(table) for table in STAGE} | {
    "attachments_raw": _table("order_id string, file_name string, gcs_path string, ingestion_time timestamp"),
}

CURATED = {
    "customers_curated": _table(
        "customer_id string, customer_name string, email string, phone string, "
        "created_date date, country string, ingestion_time timestamp"
    ),
    "orders_curated": _table(
        "order_id string, customer_id string, order_date date, order_status string, order_total double, "
        "source_updated_at timestamp, row_status string, ingestion_time timestamp"
    ),
    "order_items_curated": _table(
        "order_item_id string, order_id string, product_id string, product_name string, "
        "quantity long, unit_price double, ingestion_time timestamp"
    ),
    "payments_curated": _table(
        "payment_id string, order_id string, payment_date date, payment_method string, amount double, "
        "payment_status string, ingestion_time timestamp"
    ),
    "returns_curated": _table(
        "return_id string, order_id string, return_date date, reason string, refund_amount double, "
        "ingestion_time timestamp"
    ),
    "attachments_curated": _table("order_id string, file_name string, gcs_path string, ingestion_time timestamp"),
    "pdf_manifest_curated": _table(
        "file_name string, order_id string, document_type string, created_date date, ingestion_time timestamp"
    ),
    "data_error_logs": _table(
        "record_id string, source_table string, error_message string, raw_data string, retry_count long, "
        "created_at timestamp, resolved_flag boolean, resolved_at timestamp"
    ),
    "orphan_pdfs": _table("file_name string, order_id string, gcs_path string, detected_at timestamp, reason string"),
}

MARTS = {
    "customer_clv": _table(
        "customer_id string, total_orders long, total_spend double, avg_order_value double, "
        "first_order_date date, last_order_date date, customer_lifetime_days long, clv_amount double"
    ),
    "customer_segments": _table(
        "customer_id string, clv_amount double, total_orders long, customer_segment string"
    ),
    "monthly_sales": _table(
        "year long, month long, total_orders long, total_revenue double, avg_order_value double"
    ),
    "product_performance": _table(
        "product_id string, total_quantity_sold long, total_revenue double, total_orders long"
    ),
    "product_returns": _table(
        "product_id string, total_sold long, total_returned long, return_rate double"
    ),
}

TABLES = RAW | CURATED | MARTS

# Every table whose columns are fixed, the stage tables included.
KNOWN = TABLES | {f"{table}_stage": schema for table, schema in STAGE.items()}

# Texts that stored rows carry and that lookups compare with.
PASS = "PASS"
FAIL = "FAIL"
INVALID_NAME = "Invalid PDF filename format"
ORPHAN_ORDER = "Order ID missing in Orders"
ORPHAN_REASON = "Order ID not found"
MISSING_INVOICE = "Missing Invoice PDF"
HIGH_VALUE = "HIGH_VALUE"
MEDIUM_VALUE = "MEDIUM_VALUE"
LOW_VALUE = "LOW_VALUE"

# Zones of the object store.
LANDING_CSV = "landing/structured"
LANDING_PDF = "landing/unstructured"
PROCESSED = "processed"
ARCHIVE_PDF = "archive/pdfs"
ERROR_PDF = "error/pdfs"


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the table's columns in order, with its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].fields])
