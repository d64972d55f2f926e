"""Late documents: recover orders that were logged as missing one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.names import base_name, extract_order_id, in_zone
from vouchlake.functions.values import instant
from vouchlake.operators.curation import open_missing_invoices
from vouchlake.operators.keys import marked, within


def recover_late_documents(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Documents of orders with an open missing-invoice row, as in
    ``classify_documents``. All other files are left alone."""
    named = listing.select("path", base_name(F.col("path")).alias("file_name")).withColumn(
        "order_id", extract_order_id(F.col("file_name"))
    )
    found = within(named, open_missing_invoices(log), "order_id", "record_id")
    return found.select(
        "path",
        "file_name",
        "order_id",
        F.lit("valid").alias("outcome"),
        in_zone(schemas.ARCHIVE_PDF, F.col("file_name")).alias("dest_path"),
    )


def resolve_error_logs(log: DataFrame, recovered: DataFrame, as_of: datetime) -> DataFrame:
    """Close the open missing-invoice rows of the recovered orders."""
    closes = (
        F.col("__recovered") & (F.col("error_message") == schemas.MISSING_INVOICE) & ~F.col("resolved_flag")
    )
    # Decided once, as setting the flag would change what the test sees.
    return (
        marked(log, recovered, "record_id", "order_id", "__recovered")
        .withColumn("__closes", F.coalesce(closes, F.lit(False)))
        .withColumn("resolved_flag", F.col("resolved_flag") | F.col("__closes"))
        .withColumn("resolved_at", F.when(F.col("__closes"), instant(as_of)).otherwise(F.col("resolved_at")))
        .select(log.columns)
    )


def reset_recovered_orders(orders: DataFrame, recovered: DataFrame) -> DataFrame:
    """Set the recovered orders to PASS; the others keep their status."""
    checked = marked(orders, recovered, "order_id", "order_id", "__recovered")
    status = F.when(F.col("__recovered"), schemas.PASS).otherwise(F.col("row_status"))
    return checked.withColumn("row_status", status).select(orders.columns)
