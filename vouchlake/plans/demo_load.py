"""Inferred loads of loose CSV files into tables of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vouchlake.sinks.store import TableStore, row_counts
from vouchlake.sources.csv_drops import scan_csv_inferred


def load_files(store: TableStore, files: dict[str, str]) -> DataFrame:
    """Load each file, by table name, and count the rows of the tables.

    A table is made on its first load, with the types the file suggests, and
    emptied and filled again on a later one.
    """
    for table, path in files.items():
        store.clean_reload(table, scan_csv_inferred(store.spark, path))
    return row_counts({table: store.read(table) for table in files})
