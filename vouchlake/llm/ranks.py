"""Numbers within groups of any size: a range sort, runs counted per partition, offsets between partitions.

A window over a group would put the group into one task. Here the rows are
sorted by ranges, so that a large group lies in several partitions; each
partition numbers its own rows, and only the first group of a partition may
have begun in an earlier one. What the earlier partitions hold of it is a sum
over one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vouchlake.llm.common import stored
from vouchlake.session import ship_package

_PART, _POS, _RUN, _EDGE = "_part", "_pos", "_run", "_edge"


def _changes(batch: pa.RecordBatch, group: list[str]) -> np.ndarray:
    """Where a row's group differs from that of the row before it."""
    change = np.zeros(batch.num_rows, dtype=bool)
    for g in group:
        codes = pc.dictionary_encode(batch.column(g), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    return change


def _numbered(group: list[str]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, held, seen, edge_open = None, 0, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            place = np.arange(n)
            change = _changes(batch, group)
            change[0] = last is not None and tuple(batch.column(g)[0].as_py() for g in group) != last
            start = np.maximum.accumulate(np.where(change, place, -1))
            run = np.where(start < 0, held + place, place - start)
            edge = (start < 0) & edge_open
            edge_open = bool(edge[-1])
            last, held = tuple(batch.column(g)[n - 1].as_py() for g in group), int(run[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(seen + place), pa.array(run), pa.array(edge)]
            seen += n
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, _PART, _POS, _RUN, _EDGE])

    return number


def ranked(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """The rows with ``rank``, from 0, in ``order`` (null first) within ``group``; written on the way.

    Rows equal in ``order`` are numbered in any order, so it should tell apart
    what is told apart later.
    """
    ship_package(rows.sparkSession)
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())  # deals out equal rows
    ordered = spread.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    fields = ", ".join(f"{t.name} {t.dataType.simpleString()}" for t in ordered.schema)
    schema = f"{fields}, {_PART} int, {_POS} bigint, {_RUN} bigint, {_EDGE} boolean"
    local = stored(ordered.mapInArrow(_numbered(group), schema), label)
    # One row per partition, however many rows or groups there are.
    ends = local.groupBy(_PART).agg(
        F.min(F.struct(_POS, *group)).alias("first"), F.max(F.struct(_POS, _RUN, *group)).alias("last")
    )
    given = ends.select(_PART, F.lit(1).alias("after"), (F.col(f"last.{_RUN}") + 1).alias("n"), *[F.col(f"last.{g}").alias(g) for g in group])
    asked = ends.select(_PART, F.lit(0).alias("after"), F.lit(0).cast("long").alias("n"), *[F.col(f"first.{g}").alias(g) for g in group])
    earlier = Window.partitionBy(*group).orderBy(_PART, "after").rowsBetween(Window.unboundedPreceding, 0)
    offsets = given.unionByName(asked).withColumn("before", F.sum("n").over(earlier)).where("after = 0 and before > 0")
    offsets = offsets.select(F.col(_PART).alias("_of"), "before")
    whole = local.join(F.broadcast(offsets), (F.col(_PART) == F.col("_of")) & F.col(_EDGE), "left")
    rank = F.col(_RUN) + F.coalesce(F.col("before"), F.lit(0))
    return whole.withColumn("rank", rank).drop(_PART, _POS, _RUN, _EDGE, "_of", "before")
