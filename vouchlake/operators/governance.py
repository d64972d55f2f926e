"""The gate: an order passes when a document is attached to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.operators.keys import marked


def _checked(orders: DataFrame, attachments: DataFrame) -> DataFrame:
    checked = marked(orders, attachments, "order_id", "order_id", "__proven")
    return checked.withColumn("__status", F.when(F.col("__proven"), schemas.PASS).otherwise(schemas.FAIL)).drop("__proven")


def governance_status(orders: DataFrame, attachments: DataFrame) -> DataFrame:
    """Orders with ``row_status`` set anew: PASS with an attachment, else FAIL."""
    return _checked(orders, attachments).withColumn("row_status", F.col("__status")).select(orders.columns)


def stale_status(orders: DataFrame, attachments: DataFrame) -> DataFrame:
    """The orders whose status is not what their attachments say."""
    stale = ~F.col("row_status").eqNullSafe(F.col("__status"))
    return _checked(orders, attachments).where(stale).select(orders.columns)


def status_images(orders: DataFrame, attachments: DataFrame) -> DataFrame:
    """Orders ``before`` and ``after`` their status is set anew."""
    after = [F.col("__status" if c == "row_status" else c).alias(c) for c in orders.columns]
    return _checked(orders, attachments).select(F.struct(orders.columns).alias("before"), F.struct(after).alias("after"))
