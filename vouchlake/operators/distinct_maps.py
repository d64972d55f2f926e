"""Exact distinct counts that can be merged: bitmaps over dense order numbers.

A distinct count cannot be added to another one, its set of orders can. Orders
get dense numbers, stored once; the set of orders of a product is then a few
bitmaps, one whole number for each range of 64 order numbers that holds one,
which merge by OR and count by bits. So a product takes no more rows than it has
orders, and a hot one no more than there are ranges, never one set.
A slice of items (a month, a load) is reduced to sums and bitmaps once; a
total over any slices reads these and no item again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.operators.keys import same_key, without
from vouchlake.operators.mart_deltas import SCALE, marked_key
from vouchlake.sinks.store import TableStore

NUMBERS, SUMS, MAPS = "order_numbers", "product_sums", "product_maps"
_MONEY = "decimal(38,2)"


def add_numbers(store: TableStore, order_ids: DataFrame, token: str) -> None:
    """Number the orders that have none yet, after the last number given.

    The new ids are sorted by range and written with their place in the
    partition; the partitions' offsets are one row each.
    """
    if store.has_token(NUMBERS, token):
        return
    if not store.exists(NUMBERS):
        store.insert(NUMBERS, "order_id", store.spark.createDataFrame([], "order_id string, number long"))
    held = store.read(NUMBERS)
    fresh = without(order_ids.select("order_id").where("order_id IS NOT NULL").distinct(), held, "order_id", "order_id")
    spread = fresh.repartitionByRange("order_id").sortWithinPartitions("order_id").withColumn("at", F.monotonically_increasing_id())
    placed = store.replace(f"{NUMBERS}_new", spread.select("order_id", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at")))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    offsets = sizes.select(F.col("part").alias("of"), before.alias("before"))
    first = (held.agg(F.max("number")).first()[0] or 0) + 1
    numbered = placed.join(F.broadcast(offsets), F.col("part") == F.col("of"))
    store.insert(NUMBERS, "order_id", numbered.select("order_id", (F.col("before") + F.col("at") + first).alias("number")), token)


def sums_of(items: DataFrame) -> DataFrame:
    """What a slice of items adds to each product, beside its orders."""

    def counted(*columns: str):
        there = F.lit(True)
        for c in columns:
            there = there & F.col(c).isNotNull()
        return F.sum(there.cast("long"))

    return items.groupBy(marked_key("product_id").alias("product_key"), "product_id").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity"),
        counted("quantity").alias("counted"),
        F.coalesce(F.sum((F.col("quantity") * F.col("unit_price")).cast(f"decimal(18,{SCALE})")), F.lit(0)).cast(_MONEY).alias("revenue"),
        counted("quantity", "unit_price").alias("priced"),
    )


def maps_of(items: DataFrame, numbers: DataFrame) -> DataFrame:
    """The orders of each product in a slice of items, as bitmaps."""
    pairs = items.where("order_id IS NOT NULL").select("order_id", marked_key("product_id").alias("product_key"))
    known = numbers.select(F.col("order_id").alias("n_id"), "number")
    met = pairs.join(known, same_key(F.col("order_id"), F.col("n_id")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("number") % 64).cast("int"))
    return met.groupBy("product_key", F.shiftright("number", 6).alias("bucket")).agg(F.bit_or(bit).alias("map"))


def add_items(store: TableStore, items: DataFrame, batch: str) -> None:
    """Reduce a slice of items and keep the result under its name; a repeated slice adds nothing."""
    add_numbers(store, items, batch)
    store.append_once(SUMS, sums_of(items), batch)
    store.append_once(MAPS, maps_of(items, store.read(NUMBERS)), batch)


def product_performance(sums: DataFrame, maps: DataFrame) -> DataFrame:
    """The mart from the kept sums and bitmaps of any slices."""
    total = sums.groupBy("product_key", "product_id").agg(*[F.sum(c).alias(c) for c in ("quantity", "counted", "revenue", "priced")])
    merged = maps.groupBy("product_key", "bucket").agg(F.bit_count(F.bit_or("map")).alias("n"))
    orders = merged.groupBy(F.col("product_key").alias("o_key")).agg(F.sum("n").alias("orders"))
    both = total.join(orders, F.col("product_key") == F.col("o_key"), "left")
    return schemas.conform(
        both.select(
            "product_id",
            F.when(F.col("counted") > 0, F.col("quantity")).alias("total_quantity_sold"),
            F.when(F.col("priced") > 0, F.col("revenue").cast("double")).alias("total_revenue"),
            F.coalesce("orders", F.lit(0)).alias("total_orders"),
        ),
        "product_performance",
    )
