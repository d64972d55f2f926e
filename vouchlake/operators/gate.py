"""Golden rows and log rows of a raw table in one pass.

Every raw row is golden, to be logged, or neither, so one scan tags each row
and writes both kinds, the tag as folder. Dates are matched against their
shape once, and parsed, cast or turned to JSON only for the rows that need it.
The rules are those of ``curation``, which builds the two kinds one by one.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.dates import has_date_shape, is_impossible_date, parse_shaped_date
from vouchlake.functions.values import row_json
from vouchlake.operators.curation import open_missing_invoices
from vouchlake.operators.keys import marked
from vouchlake.operators.linking import log_row

TAG, GOLDEN, LOG = "tag", "golden", "log"


class Rules(NamedTuple):
    key: str
    date: str
    cascades: bool  # only rows of golden orders are golden


RULES = {
    "customers": Rules("customer_id", "created_date", False),
    "orders": Rules("order_id", "order_date", False),
    "payments": Rules("payment_id", "payment_date", True),
    "returns": Rules("return_id", "return_date", True),
    "pdf_manifest": Rules("file_name", "created_date", False),
}


def _message(table: str, date: str, impossible: bool, missing: bool) -> Column:
    """Why a row is logged; NULL if it is not."""
    text = F.col(date)
    message = F.when(~has_date_shape(text), f"Invalid {date} format")
    if impossible:
        message = message.when(is_impossible_date(text), f"Impossible {date}")
    if missing:
        message = message.when(text.isNull(), f"Missing {date}")
    if table != "orders":
        return message
    unproven = (F.col("row_status") == schemas.FAIL) & ~F.col("__logged")
    return F.when(F.col("row_status") == schemas.PASS, message).when(unproven, schemas.MISSING_INVOICE)


def gated(
    table: str,
    raw: DataFrame,
    as_of: datetime,
    orders: DataFrame | None = None,
    log: DataFrame | None = None,
    on_bad_date: str = "fail",
    missing: bool = False,
) -> DataFrame:
    """The rows of a raw table that are golden or logged: ``tag``, the golden columns, the log's columns.

    ``orders`` are the golden orders, for tables that follow them; ``log`` is
    the error log, for orders. Columns of the other kind are NULL. The gate of
    the orders themselves is their status.
    """
    rules, golden = RULES[table], schemas.CURATED[f"{table}_curated"]
    rows = raw
    if rules.cascades:
        rows = marked(rows, orders, "order_id", "order_id", "__member")
    if table == "orders":
        logged = open_missing_invoices(log).filter(F.col("source_table") == "orders_raw")
        rows = marked(rows, logged, "order_id", "record_id", "__logged")
    text, quarantine = F.col(rules.date), on_bad_date == "quarantine"
    passes = F.col("__member") if rules.cascades else F.col("row_status") == schemas.PASS if table == "orders" else F.lit(True)
    rows = rows.withColumn("__message", _message(table, rules.date, quarantine, missing))
    shaped = F.coalesce(has_date_shape(text), F.lit(False)) & F.coalesce(passes, F.lit(False))
    tag = F.when(F.col("__message").isNotNull(), LOG).when(shaped & (~is_impossible_date(text) if quarantine else F.lit(True)), GOLDEN)
    rows = rows.withColumn(TAG, tag).where(F.col(TAG).isNotNull())
    is_golden, is_log = F.col(TAG) == GOLDEN, F.col(TAG) == LOG

    def kept(name: str, kind) -> Column:
        value = parse_shaped_date(text, on_bad_date) if name == rules.date else F.col(name)
        return F.when(is_golden, value.cast(kind)).alias(name)

    told = log_row(F.col(rules.key), f"{table}_raw", F.col("__message"), row_json(raw.columns), as_of)
    names = schemas.CURATED["data_error_logs"].fieldNames()
    return rows.select(TAG, *[kept(f.name, f.dataType) for f in golden], *[F.when(is_log, c).alias(n) for c, n in zip(told, names, strict=True)])
