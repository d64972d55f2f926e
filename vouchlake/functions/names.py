"""Object names: base name, extension, order id, destination path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the invoice file name. (?U) lets \d match any Unicode digit and
# (?d) keeps $ to a line feed, so odd names are judged as they always were.
INVOICE_NAME = r"(?dU)^invoice_(O\d+)_\d{8}\.pdf$"

# Base and extension split at the last dot, leading dots not counted.
_STEM_AND_EXTENSION = r"(?s)^(\.*[^.].*)(\.[^.]*)$"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extract_order_id(file_name: Column) -> Column:
    """The order id in an invoice file name, NULL when the name does not fit."""
    return F.nullif(F.regexp_extract(file_name, INVOICE_NAME, 1), F.lit(""))


def stem(file_name: Column) -> Column:
    found = F.regexp_extract(file_name, _STEM_AND_EXTENSION, 1)
    return F.when(found == "", file_name).otherwise(found)


def extension(file_name: Column) -> Column:
    return F.regexp_extract(file_name, _STEM_AND_EXTENSION, 2)


def is_pdf(path: Column) -> Column:
    return F.lower(path).endswith(".pdf")


def is_csv(path: Column) -> Column:
    return path.endswith(".csv")


def in_zone(zone: str, file_name: Column) -> Column:
    return F.concat(F.lit(zone + "/"), file_name)


def store_uri(store_root: str, path: Column) -> Column:
    return F.concat(F.lit(store_root.rstrip("/") + "/"), path)


def archived_csv(path: Column, updated: Column) -> Column:
    """Name of a loaded CSV in the processed zone, stamped with its update time."""
    name = base_name(path)
    stamp = F.date_format(updated, "yyyyMMdd'T'HHmmss")
    return F.concat(F.lit("processed/"), stem(name), F.lit("_"), stamp, extension(name))
