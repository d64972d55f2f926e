"""Listing of the landing zone."""

from __future__ import annotations

import itertools
import os
import re
import stat
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchlake.functions.names import base_name, is_pdf
from vouchlake.session import scratch_dir, ship_package
from vouchlake.sinks.moves import file_system

_ROWS_PER_BATCH = 10_000
_MOST_TASKS = 10_000

LISTING_COLUMNS = ["path", "modificationTime", "length"]
_FOUND = "path string, modificationTime timestamp, length bigint, folder boolean"


def _local_files(folder: str) -> Iterator[tuple]:
    """What a local folder holds, entry by entry: a large folder is never held whole."""
    try:
        entries = os.scandir(folder)
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            try:
                about = entry.stat()
            except FileNotFoundError:  # a link to nowhere, or gone since
                continue
            size = about.st_size if stat.S_ISREG(about.st_mode) else None
            yield entry.name, about.st_mtime_ns // 1000, size, stat.S_ISDIR(about.st_mode)


def _store_files(store, folder: str) -> Iterator[tuple]:
    from pyarrow import fs as afs

    for f in store.get_file_info(afs.FileSelector(folder, allow_not_found=True)):
        is_folder = f.type == afs.FileType.Directory
        yield f.base_name, None if f.mtime_ns is None else f.mtime_ns // 1000, None if is_folder else f.size, is_folder


def _list_folders(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = file_system(root)
        for batch in batches:
            for folder in batch["path"]:
                inside = f"{base}/{folder}".rstrip("/")
                found = _local_files(inside) if store.type_name == "local" else _store_files(store, inside)
                while part := list(itertools.islice(found, _ROWS_PER_BATCH)):
                    names, times, lengths, folders = zip(*part, strict=True)
                    yield pd.DataFrame(
                        {
                            "path": [f"{folder}/{name}" if folder else name for name in names],
                            "modificationTime": pd.to_datetime(pd.Series(times, dtype="Int64"), unit="us", utc=True),
                            "length": pd.array(lengths, dtype="Int64"),
                            "folder": folders,
                        }
                    )

    return run


def list_landing(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file below ``root`` with its update time and size, whatever its name.

    Tasks list the folders, level by level, and write what they find; the
    driver sees no file. A folder is listed by one task, so a zone that holds
    very many objects in one folder should bring the store's own inventory
    report: operators take any DataFrame with these columns.
    """
    ship_package(spark)
    level, levels = spark.createDataFrame([("",)], "path string"), []
    while True:
        # Folders are few bytes each but slow to list, so each is a task of its own up to a point.
        path = scratch_dir(spark, "listing")
        level.repartition(max(1, min(level.count(), _MOST_TASKS)), "path").mapInPandas(_list_folders(root), _FOUND).write.parquet(path)
        levels.append(spark.read.schema(_FOUND).parquet(path))
        level = levels[-1].where("folder").select("path")
        if level.isEmpty():
            break
    found = levels[0]
    for more in levels[1:]:
        found = found.unionByName(more)
    files = found.where(~F.col("folder"))
    if glob:
        files = files.where(F.regexp_like(base_name(F.col("path")), F.lit(_glob_pattern(glob))))
    return files.select(F.concat(F.lit(root.rstrip("/") + "/"), "path").alias("path"), "modificationTime", "length")


def _glob_pattern(glob: str) -> str:
    """A pattern for names with ``*`` and ``?``."""
    parts = {"*": ".*", "?": "."}
    return "^" + "".join(parts.get(c, re.escape(c)) for c in glob) + r"\z"


def relative_to(listing: DataFrame, root: str) -> DataFrame:
    """Paths relative to the store root, whatever scheme prefix they carry."""
    base = root.split("://", 1)[-1].rstrip("/") + "/"
    start = F.instr(F.col("path"), base)
    tail = F.substr(F.col("path"), start + len(base))
    return listing.withColumn("path", F.when(start > 0, tail).otherwise(F.col("path")))


def filter_documents(listing: DataFrame) -> DataFrame:
    return listing.filter(is_pdf(F.col("path")))
