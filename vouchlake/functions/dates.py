"""Two-format dates: shape test, parsing, and what to do with impossible days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the two accepted shapes, dd-MM-yyyy and yyyy-MM-dd. \z and not
# $, because $ in Java also accepts a trailing line break.
DATE_SHAPE = r"^(?:\d{2}-\d{2}-\d{4}|\d{4}-\d{2}-\d{2})\z"


def has_date_shape(text: Column) -> Column:
    """True when the text looks like dd-MM-yyyy or yyyy-MM-dd; NULL for NULL."""
    return text.rlike(DATE_SHAPE)


def _day(shaped: Column) -> Column:
    """The day a text of either shape names, NULL if there is none.

    Reordering to ISO first lets Spark's plain string-to-date cast do the
    parsing, which costs far less per row than a pattern formatter.
    """
    day_first = F.concat(
        F.substring(shaped, 7, 4), F.lit("-"), F.substring(shaped, 4, 2), F.lit("-"), F.substring(shaped, 1, 2)
    )
    iso = F.when(F.substring(shaped, 3, 1) == "-", day_first).otherwise(shaped)
    # Year zero is outside the calendar the data uses.
    return F.when(~iso.startswith("0000"), iso.try_cast("date"))


def is_impossible_date(text: Column) -> Column:
    """True for text of a valid shape that names no day, such as 31-02-2024."""
    return F.coalesce(has_date_shape(text), F.lit(False)) & _day(text).isNull()


def parse_shaped_date(shaped: Column, on_bad_date: str = "fail") -> Column:
    """The date of a text known to have one of the shapes, or NULL.

    An impossible day fails the job, or yields NULL under ``"quarantine"``.
    """
    day = _day(shaped)
    if on_bad_date == "quarantine":
        return day
    if on_bad_date != "fail":
        raise ValueError(f"on_bad_date must be 'fail' or 'quarantine', not {on_bad_date!r}")
    problem = F.raise_error(F.concat(F.lit("impossible date: "), shaped)).cast("date")
    return F.when(day.isNotNull() | shaped.isNull(), day).otherwise(problem)


def parse_date(text: Column, on_bad_date: str = "fail") -> Column:
    """The date of any text: NULL for NULL and for text of another shape."""
    return F.when(has_date_shape(text), parse_shaped_date(text, on_bad_date))
