"""Groups of any size as tiles of bounded size: pairs of blocks.

A group is cut into blocks by hash; its rows are copied so that every two
blocks meet in one tile. What must be seen pair by pair is then seen whole,
and a task holds two blocks, however large the group is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchlake.operators.keys import same_key


def tiled(rows: DataFrame, keys: list[str], weight: Column, most: int, by: str = "doc_id") -> DataFrame:
    """Rows of groups of two or more, copied to the tiles of their group.

    ``low`` and ``high`` name the two blocks of a tile, ``block`` the row's own;
    blocks weigh about ``most``.
    """
    return dealt(rows, group_blocks(rows, keys, weight, most), keys, by)


def group_blocks(rows: DataFrame, keys: list[str], weight: Column, most: int) -> DataFrame:
    """The groups of two or more, with the number of their blocks."""
    total = rows.groupBy(*keys).agg(F.ceil(F.sum(weight) / most).cast("int").alias("blocks"), F.count(F.lit(1)).alias("members"))
    return total.where(F.col("members") > 1).select(*[F.col(k).alias(f"t_{k}") for k in keys], "blocks")


def dealt(rows: DataFrame, total: DataFrame, keys: list[str], by: str = "doc_id") -> DataFrame:
    """Rows of the groups in ``total``, copied to the tiles of their group."""
    same = same_key(F.col(keys[0]), F.col(f"t_{keys[0]}"))
    for k in keys[1:]:
        same = same & (F.col(k) == F.col(f"t_{k}"))
    block = F.pmod(F.xxhash64(by), F.col("blocks")).cast("int")
    return (
        rows.join(total, same)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "blocks", *[f"t_{k}" for k in keys])
    )


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The runs of rows with equal keys, whole, also across batches."""
    open_run: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for first, last in zip(starts, starts[1:], strict=False):
            part = batch.slice(first, last - first)
            if open_run and any(open_run[-1].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.concat_batches(open_run)
                open_run = []
            open_run.append(part)
    if open_run:
        yield pa.concat_batches(open_run)
