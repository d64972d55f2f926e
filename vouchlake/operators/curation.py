"""Golden tables and the error-log rows of what they leave out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.dates import has_date_shape, is_impossible_date, parse_shaped_date
from vouchlake.functions.values import row_json
from vouchlake.operators.keys import cascade, same_key, without
from vouchlake.operators.linking import log_row

def _passes() -> Column:
    return F.col("row_status") == schemas.PASS


def _dated(raw: DataFrame, date_column: str, on_bad_date: str) -> DataFrame:
    """Rows whose date parses, with the date in place of its text.

    The filter tests shapes only and raises nothing, so Spark may move it to
    the scan; dates are parsed above it, for rows that are kept.
    """
    text = F.col(date_column)
    shaped = raw.filter(has_date_shape(text)).withColumn(date_column, parse_shaped_date(text, on_bad_date))
    return shaped.filter(text.isNotNull()) if on_bad_date == "quarantine" else shaped


def curate_customers(raw: DataFrame, on_bad_date: str = "fail") -> DataFrame:
    return schemas.conform(_dated(raw, "created_date", on_bad_date), "customers_curated")


def curate_orders(raw: DataFrame, on_bad_date: str = "fail") -> DataFrame:
    """The gate of the golden layer: PASS orders with a usable date."""
    return schemas.conform(_dated(raw.filter(_passes()), "order_date", on_bad_date), "orders_curated")


def curate_order_items(raw: DataFrame, orders_curated: DataFrame) -> DataFrame:
    return schemas.conform(cascade(raw, orders_curated, "order_id"), "order_items_curated")


def curate_payments(raw: DataFrame, orders_curated: DataFrame, on_bad_date: str = "fail") -> DataFrame:
    dated = _dated(raw, "payment_date", on_bad_date)
    return schemas.conform(cascade(dated, orders_curated, "order_id"), "payments_curated")


def curate_returns(raw: DataFrame, orders_curated: DataFrame, on_bad_date: str = "fail") -> DataFrame:
    dated = _dated(raw, "return_date", on_bad_date)
    return schemas.conform(cascade(dated, orders_curated, "order_id"), "returns_curated")


def curate_attachments(raw: DataFrame, orders_curated: DataFrame) -> DataFrame:
    return schemas.conform(cascade(raw, orders_curated, "order_id"), "attachments_curated")


def curate_pdf_manifest(raw: DataFrame, on_bad_date: str = "fail") -> DataFrame:
    """Dated manifest rows, whether or not their order passed."""
    return schemas.conform(_dated(raw, "created_date", on_bad_date), "pdf_manifest_curated")


def _date_errors(
    raw: DataFrame, table: str, key: str, date_column: str, as_of: datetime, impossible: bool, missing: bool
) -> DataFrame:
    """Log rows for dates of a wrong shape; on request for others left out."""
    text = F.col(date_column)
    message = F.when(~has_date_shape(text), f"Invalid {date_column} format")
    if impossible:
        message = message.when(is_impossible_date(text), f"Impossible {date_column}")
    if missing:
        message = message.when(text.isNull(), f"Missing {date_column}")
    rows = log_row(F.col(key), table, message, row_json(raw.columns), as_of)
    return raw.filter(message.isNotNull()).select(rows)


def errors_customer_dates(
    raw: DataFrame, as_of: datetime, impossible: bool = False, missing: bool = False
) -> DataFrame:
    return _date_errors(raw, "customers_raw", "customer_id", "created_date", as_of, impossible, missing)


def errors_order_dates(raw: DataFrame, as_of: datetime, impossible: bool = False, missing: bool = False) -> DataFrame:
    """Orders that pass the gate but have no usable date."""
    passed = raw.filter(_passes())
    return _date_errors(passed, "orders_raw", "order_id", "order_date", as_of, impossible, missing)


def errors_payment_dates(
    raw: DataFrame, as_of: datetime, impossible: bool = False, missing: bool = False
) -> DataFrame:
    return _date_errors(raw, "payments_raw", "payment_id", "payment_date", as_of, impossible, missing)


def errors_return_dates(raw: DataFrame, as_of: datetime, impossible: bool = False, missing: bool = False) -> DataFrame:
    return _date_errors(raw, "returns_raw", "return_id", "return_date", as_of, impossible, missing)


def errors_manifest_dates(
    raw: DataFrame, as_of: datetime, impossible: bool = False, missing: bool = False
) -> DataFrame:
    return _date_errors(raw, "pdf_manifest_raw", "file_name", "created_date", as_of, impossible, missing)


def open_missing_invoices(log: DataFrame) -> DataFrame:
    """Unresolved log rows of orders without a document."""
    return log.filter((F.col("error_message") == schemas.MISSING_INVOICE) & ~F.col("resolved_flag"))


def errors_missing_invoice(raw: DataFrame, log: DataFrame, as_of: datetime) -> DataFrame:
    """Failed orders that have no open log row of this kind yet."""
    logged = open_missing_invoices(log).filter(F.col("source_table") == "orders_raw")
    failed = raw.filter(F.col("row_status") == schemas.FAIL)
    fresh = without(failed, logged, "order_id", "record_id")
    return fresh.select(
        log_row(F.col("order_id"), "orders_raw", schemas.MISSING_INVOICE, row_json(raw.columns), as_of)
    )


def only_new_errors(errors: DataFrame, log: DataFrame) -> DataFrame:
    """Errors not open in the log yet, for runs that must not log one twice."""
    names = ["record_id", "source_table", "error_message"]
    listed = log.filter(~F.col("resolved_flag")).select([F.col(c).alias(f"__{c}") for c in names]).distinct()
    same = same_key(F.col("record_id"), F.col("__record_id"))
    for c in names[1:]:
        same = same & (F.col(c) == F.col(f"__{c}"))
    return errors.join(listed, same, "left_anti")
