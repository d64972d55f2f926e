"""Small scalar helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: datetime) -> Column:
    """One clock reading for a whole run; a naive datetime is taken as UTC."""
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc)
    return F.to_timestamp(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")))


def row_json(columns: Iterable[str | Column]) -> Column:
    """The row as JSON text, NULL fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def money_sum(amount: Column, scale: int | None) -> Column:
    """Sum of a DOUBLE amount.

    Adding doubles gives last digits that depend on the order of the rows, so
    on the shuffle. With ``scale`` the amounts are added as decimals of that
    many places: the sum is the same on every run, provided the amounts have
    no finer digits.
    """
    if scale is None:
        return F.sum(amount)
    return F.sum(amount.cast(f"decimal(18,{scale})"))
