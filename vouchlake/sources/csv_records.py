"""The records of CSV files whose quoted cells hold line breaks, read in splits.

A line is inside quotes if an odd number of quotes stands before it in its
file. That is a sum: the quotes of each split are counted first, one row per
split, and their prefix sums tell every split how it begins. Each task then
finds its records on its own; what a split has of a record that began before
it, or ends after it, is put together afterwards, at most two pieces a split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vouchlake.session import ship_package

WHOLE, HEAD, TAIL = 0, 1, 2
# Cells without quotes, or quoted with inner quotes doubled.
_CELL = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
WELL_FORMED = rf"^{_CELL}(?:,{_CELL})*+\z"


def _quotes() -> Column:
    return (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2


class _Split:
    """The open record of a split while its lines pass by."""

    def __init__(self, inside: int):
        self.inside, self.lines, self.kind, self.seen = inside, [], TAIL if inside else WHOLE, False


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "block", "kind", "first", "record"]
    key, split = None, _Split(0)

    def batch_of(file: str, block: int, found: list[tuple[int, bool, str]]) -> pa.RecordBatch:
        kinds, first, texts = zip(*found, strict=True)
        columns = [pa.array([file] * len(found)), pa.array([block] * len(found), pa.int64())]
        columns += [pa.array(kinds, pa.int32()), pa.array(first, pa.bool_()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def left(key: tuple[str, int], split: _Split) -> Iterator[pa.RecordBatch]:
        """A record that the split does not end; an unended tail is the whole split."""
        if split.lines:
            text = "\n".join(split.lines)
            yield batch_of(*key, [(TAIL if split.kind == TAIL else HEAD, key[1] == 0 and not split.seen, text)])

    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_numpy()
        odd = (pc.count_substring(batch.column("value"), '"').to_numpy() % 2).astype(np.int64)
        cuts = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1 if len(blocks) else []
        cuts = sorted({0, *np.asarray(cuts).tolist(), *[k for k in range(1, len(files)) if files[k] != files[k - 1]], len(files)})
        for a, b in zip(cuts, cuts[1:], strict=False):
            now = (files[a], int(blocks[a]))
            if now != key:
                if key is not None:
                    yield from left(key, split)
                key, split = now, _Split(int(batch.column("inside")[a].as_py()))
            before = (split.inside + np.cumsum(odd[a:b]) - odd[a:b]) % 2
            found, values = [], batch.column("value").slice(a, b - a).to_pylist()
            for value, inside, flips in zip(values, before.tolist(), odd[a:b].tolist(), strict=True):
                if not inside and not flips:
                    if value.strip():
                        found.append((WHOLE, key[1] == 0 and not split.seen, value))
                        split.seen = True
                    continue
                split.lines.append(value)
                if inside and flips:  # the quotes close, and with them the record
                    found.append((split.kind, key[1] == 0 and not split.seen, "\n".join(split.lines)))
                    split.seen, split.lines, split.kind = True, [], WHOLE
            split.inside = int((before[-1] + odd[b - 1]) % 2)
            if found:
                yield batch_of(*key, found)
    if key is not None:
        yield from left(key, split)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, first, record)``: every record but blank ones; ``first`` marks that of its file."""
    ship_package(spark)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    odd = lines.groupBy("file", "block").agg((F.sum(_quotes()) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = odd.select(
        F.col("file").alias("b_file"), F.col("block").alias("b_block"), (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("inside")
    )
    # One row per split; lines stay in the order they are read.
    known = lines.join(F.broadcast(begins), (F.col("file") == F.col("b_file")) & (F.col("block") == F.col("b_block")))
    found = known.select("file", "block", "value", "inside").mapInArrow(_pieces, "file string, block long, kind int, first boolean, record string")
    whole = found.where(F.col("kind") == WHOLE).select("file", "first", "record")
    # A tail belongs to the last head before it.
    owner = F.last(F.when(F.col("kind") == HEAD, F.col("block")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    )
    parts = found.where(F.col("kind") != WHOLE).withColumn("owner", owner)
    joined = parts.groupBy("file", "owner").agg(
        F.max("first").alias("first"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda p: p["record"]), "\n").alias("record")
    )
    return whole.unionByName(joined.select("file", "first", "record"))
