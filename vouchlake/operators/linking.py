"""Linking landing documents to orders by file name."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.names import base_name, extract_order_id, in_zone, is_pdf, store_uri
from vouchlake.functions.values import instant, row_json
from vouchlake.operators.keys import marked


def classify_documents(listing: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per file: ``path, file_name, order_id, outcome, dest_path``.

    ``ignored``: no PDF suffix, the file stays where it is. ``invalid``: a PDF
    whose name does not fit, which includes an upper-case suffix. ``orphan``:
    the order is unknown. ``valid``: the rest.
    """
    named = listing.select(
        "path", base_name(F.col("path")).alias("file_name"), is_pdf(F.col("path")).alias("__pdf")
    ).withColumn("order_id", extract_order_id(F.col("file_name")))
    # A file without an order id joins under its own path, not under NULL:
    # many misnamed files would otherwise all meet in one task.
    probe = F.coalesce(F.col("order_id"), F.col("path"))
    outcome = (
        F.when(~F.col("__pdf"), "ignored")
        .when(F.col("order_id").isNull(), "invalid")
        .when(~F.col("__known"), "orphan")
        .otherwise("valid")
    )
    dest = (
        F.when(F.col("outcome") == "valid", in_zone(schemas.ARCHIVE_PDF, F.col("file_name")))
        .when(F.col("outcome") != "ignored", in_zone(schemas.ERROR_PDF, F.col("file_name")))
    )
    return (
        marked(named.withColumn("__probe", probe), orders, "__probe", "order_id", "__known")
        .withColumn("outcome", outcome)
        .select("path", "file_name", "order_id", "outcome", dest.alias("dest_path"))
    )


def attachment_rows(documents: DataFrame, store_root: str, as_of: datetime) -> DataFrame:
    """``attachments_raw`` rows of documents that carry a destination."""
    return documents.select(
        "order_id",
        "file_name",
        store_uri(store_root, F.col("dest_path")).alias("gcs_path"),
        instant(as_of).alias("ingestion_time"),
    )


def link_attachments(classified: DataFrame, store_root: str, as_of: datetime) -> DataFrame:
    """Every valid document, also several for one order."""
    return attachment_rows(classified.filter(F.col("outcome") == "valid"), store_root, as_of)


def orphan_documents(classified: DataFrame, store_root: str, as_of: datetime) -> DataFrame:
    return classified.filter(F.col("outcome") == "orphan").select(
        "file_name",
        "order_id",
        store_uri(store_root, F.col("dest_path")).alias("gcs_path"),
        instant(as_of).alias("detected_at"),
        F.lit(schemas.ORPHAN_REASON).alias("reason"),
    )


def log_row(record_id: Column, source: str, message: str | Column, raw_data: Column, as_of: datetime) -> list[Column]:
    """The columns of an open error-log row."""
    message = F.lit(message) if isinstance(message, str) else message
    return [
        record_id.alias("record_id"),
        F.lit(source).alias("source_table"),
        message.alias("error_message"),
        raw_data.alias("raw_data"),
        F.lit(0).cast("bigint").alias("retry_count"),
        instant(as_of).alias("created_at"),
        F.lit(False).alias("resolved_flag"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    ]


def errors_invalid_documents(classified: DataFrame, as_of: datetime) -> DataFrame:
    name = F.col("file_name")
    return classified.filter(F.col("outcome") == "invalid").select(
        log_row(name, "pdf_ingest", schemas.INVALID_NAME, row_json([name]), as_of)
    )


def errors_orphan_documents(classified: DataFrame, as_of: datetime) -> DataFrame:
    return classified.filter(F.col("outcome") == "orphan").select(
        log_row(
            F.col("order_id"), "orphan_pdfs", schemas.ORPHAN_ORDER, row_json(["file_name", "order_id"]), as_of
        )
    )


def document_errors(classified: DataFrame, as_of: datetime) -> DataFrame:
    """Log rows of invalid and of orphan documents, in one pass."""
    invalid = F.col("outcome") == "invalid"
    raw = F.when(invalid, row_json(["file_name"])).otherwise(row_json(["file_name", "order_id"]))
    rows = log_row(
        F.when(invalid, F.col("file_name")).otherwise(F.col("order_id")),
        "",
        F.when(invalid, schemas.INVALID_NAME).otherwise(schemas.ORPHAN_ORDER),
        raw,
        as_of,
    )
    rows[1] = F.when(invalid, "pdf_ingest").otherwise("orphan_pdfs").alias("source_table")
    return classified.filter(F.col("outcome").isin("invalid", "orphan")).select(rows)
