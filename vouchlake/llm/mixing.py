"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source the documents are put in
key order, a prefix sum of their sizes is taken, and the source is cut where
its budget ends; a budget above the source's size repeats it, epoch by epoch.

Keys are uniform, so equal ranges of them are equal shares of a source: the
first digits of the key name the range. Sizes are summed per range, the ranges
(a fixed number for each source) are accumulated, and each range is then sorted
and accumulated on its own, starting from what the ranges before it hold. No
task sees more than one range of one source.

Defined cases: a null text or one without words has size 0 and takes nothing.
A null source is a source like any other, last in order. Documents with equal
key (rows with one ``doc_id``) go by size; rows equal in both are exchangeable.
An empty table gives no rows. Other columns of the input are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouchlake.llm.common import free_name, stored, word_count

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # the mix has this share of all words
MAX_EPOCHS = 2
KEY_DIGITS = 3  # hexadecimal digits that name a key range: 4096 ranges a source
BROADCAST_SOURCES = 10_000  # cuts of more sources are joined, not broadcast


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code-point order, null last, weigh ``weights`` in turn. They
    split ``share`` of all words by weight; no target passes ``max_epochs``
    times its source, and the excess is split again by weight. In order of
    size by weight that is a water level: sources are full until the rest
    fits. All of it is integer arithmetic but the last division. One row per
    source goes through one task.
    """
    p, q = share
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    listed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    )
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    full = F.col("source_size") * max_epochs
    level = (
        listed.withColumn("full", full)
        .withColumn("left", F.sum("source_size").over(everything) * p - F.coalesce(F.sum("full").over(before), F.lit(0)) * q)
        .withColumn("by", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("fits", F.col("weight") * F.col("left") <= F.col("full") * F.col("by") * q)
        .withColumn(
            "level",
            F.max(F.when(F.col("fits"), F.struct("by", "left"))).over(everything),
        )
    )
    fair = (F.col("weight") * F.col("level.left")).cast("double") / (F.col("level.by") * q)
    target = F.when(F.col("fits"), fair).otherwise(F.col("full").cast("double"))
    return level.select("source", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """One row per document: its size, its source's target, the words the mix takes.

    ``taken`` counts repeats; the document at the cut gives a part of its
    words, so the words taken of a source are its target rounded down.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = stored(
        docs.select("doc_id", "source", word_count().alias("size"), key.alias("key")).withColumn(
            "range", F.substring("key", 1, KEY_DIGITS)
        ),
        "mix-keys",
    )
    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    sources = source_targets(
        ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, share, max_epochs
    )
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    based = ranges.withColumn("base", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
    based = _join(based, sources, "source").select(
        "source", "range", "base", "source_size", "target"
    )
    inside = Window.partitionBy("source", "range").orderBy("key", F.asc_nulls_first("doc_id"), "size")
    placed = _join(keyed, based, "source", "range").withColumn(
        "start",
        F.col("base") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)).cast("long")
    return (
        placed.withColumn("epochs", epochs)
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumn(
            "taken",
            F.col("epochs") * F.col("size")
            + F.least(F.greatest(F.col("rest") - F.col("start"), F.lit(0)), F.col("size")),
        )
        .select("doc_id", "source", "key", "size", "source_size", "target", "epochs", "rest", "start", "taken")
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """The documents of the mix, whole, each as often as the mix repeats it.

    A source's last epoch ends with the document that has its middle before
    the cut. Only the cut of each source, not the plan, meets the texts.
    """
    plan = mix_plan(docs, weights, share, max_epochs)
    ends = F.when(
        (F.col("rest") > 0) & (F.col("start") * 2 + F.col("size") <= F.col("rest") * 2), F.struct(*_order())
    )
    cuts = stored(
        plan.groupBy("source").agg(F.first("epochs").alias("mix_epochs"), F.max(ends).alias("mix_end")), "mix-cuts"
    )
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    key = F.md5(F.coalesce(F.col("d.doc_id").cast("string"), F.lit("")))
    here = F.struct(
        key.alias("key"), _null_first("d.doc_id"), F.col("d.doc_id").alias("doc_id"), word_count("d.text").alias("size")
    )
    joined = docs.alias("d").join(cuts.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")))
    copies = (F.col("c.mix_epochs") + F.coalesce(_here(here), F.lit(0))).cast("int")
    copy = free_name(docs, "copy")
    repeated = joined.select("d.*", F.explode(F.array_repeat(F.lit(True), copies)).alias(copy))
    return repeated.drop(copy)


def _null_first(name: str) -> Column:
    return F.col(name).isNotNull().alias("known")


def _order() -> list[Column]:
    return [F.col("key"), _null_first("doc_id"), F.col("doc_id"), F.col("size")]


def _here(place: Column) -> Column:
    return (place <= F.col("c.mix_end")).cast("long")


def _join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join on keys of which the source may be null."""
    renamed = right.select([F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"r_{k}" for k in keys])
