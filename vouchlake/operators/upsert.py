"""Keyed upsert of a batch into a table, and the rules of the six raw tables.

One full outer join: the batch is shuffled once by key, counted there, and
meets the table, which is shuffled once too. Rows without key are spread, as
they match nothing. Nothing runs while the plan is made. Stored tables are
merged by ``TableStore.merge``, which hands over the rows of those files only
that hold a key of the batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.values import instant

_COPIES, _SPREAD, _STORED = "__copies", "__spread", "__stored"


def new(column: str) -> Column:
    """A column of the incoming batch, inside an upsert rule."""
    return F.col(f"batch_row.`{column}`")


def old(column: str) -> Column:
    """A column of the stored table, inside an upsert rule."""
    return F.col(f"stored_row.`{column}`")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """A second key that deals out the rows without the first one."""
    by = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).otherwise(F.lit(0))
    return df.withColumn(_SPREAD, by)


def _joined(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: dict[str, Column],
    insert: dict[str, Column],
    update_when: Column | None,
) -> tuple[DataFrame, dict[str, Column]]:
    """Table and batch side by side, and what each column becomes."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(key, _SPREAD))
    batch = _spread(source, key).withColumn(_COPIES, copies).alias("batch_row")
    message = F.concat(F.lit("more than one batch row for stored key "), new(key).cast("string"))
    met = new(key).isNotNull() & F.coalesce(old(_STORED), F.lit(False))
    single = F.when(met & (new(_COPIES) > 1), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    change = met if update_when is None else met & F.coalesce(update_when, F.lit(False))

    def becomes(c: str) -> Column:
        kept = F.when(change, update[c]).otherwise(old(c)) if c in update else old(c)
        return F.when(old(_STORED), kept).otherwise(insert.get(c, F.lit(None)).cast(target.schema[c].dataType))

    held = _spread(target, key).withColumn(_STORED, F.lit(True)).alias("stored_row")
    both = held.join(batch, (old(key) == new(key)) & (old(_SPREAD) == new(_SPREAD)), "full_outer").where(single)
    return both, {c: becomes(c) for c in target.columns}


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: dict[str, Column],
    insert: dict[str, Column],
    update_when: Column | None = None,
) -> DataFrame:
    """The table after merging ``source`` into ``target`` on ``key``.

    A matched row takes the ``update`` expressions where ``update_when`` holds
    and keeps everything else. An unmatched batch row is inserted with the
    ``insert`` expressions (a column left out is NULL). A NULL key matches
    nothing, so such batch rows are always inserted; so is every copy of a
    key the table does not hold yet. Copies of a key it holds fail the job,
    whatever ``update_when`` says.
    """
    both, becomes = _joined(target, source, key, update, insert, update_when)
    return both.select([c.alias(name) for name, c in becomes.items()])


def upsert_images(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: dict[str, Column],
    insert: dict[str, Column],
    update_when: Column | None = None,
) -> DataFrame:
    """The same merge as row images: ``before`` (NULL for an insert) and ``after``."""
    both, becomes = _joined(target, source, key, update, insert, update_when)
    before = F.when(old(_STORED), F.struct([old(c).alias(c) for c in target.columns]))
    return both.select(before.alias("before"), F.struct([c.alias(name) for name, c in becomes.items()]).alias("after"))


def replaced_images(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Row images of a merge that takes the batch rows as they are."""
    columns = {c: new(c) for c in target.columns}
    return upsert_images(target, source, key, {c: v for c, v in columns.items() if c != key}, columns)


# Columns an update leaves as they were first inserted, beside the key.
_KEEP_ON_UPDATE = {"order_items": {"order_id", "product_id"}}


def _raw_rules(table: str, as_of: datetime) -> dict:
    """What a merge into one of the six raw tables updates and inserts."""
    key = schemas.KEYS[table]
    fields = schemas.STAGE[table].fieldNames()
    stamp = {"ingestion_time": instant(as_of), "source_file": F.lit(schemas.STAGE_FILES[table])}
    fixed = {key} | _KEEP_ON_UPDATE.get(table, set())
    rules = {"key": key, "update": {c: new(c) for c in fields if c not in fixed} | stamp, "insert": {c: new(c) for c in fields} | stamp}
    if table == "orders":
        # An order changes only by a strictly newer version and keeps its status.
        rules["insert"]["row_status"] = F.lit(schemas.FAIL)
        rules["update_when"] = new("source_updated_at").cast("timestamp") > old("source_updated_at").cast("timestamp")
    return rules


def merge_into_raw(table: str, target: DataFrame, stage: DataFrame, as_of: datetime) -> DataFrame:
    """Merge the stage rows of one of the six landing tables into its raw table."""
    return upsert(target, stage, **_raw_rules(table, as_of))


def raw_images(table: str, target: DataFrame, stage: DataFrame, as_of: datetime) -> DataFrame:
    """The same merge as row images."""
    return upsert_images(target, stage, **_raw_rules(table, as_of))
