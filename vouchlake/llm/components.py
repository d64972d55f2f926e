"""Connected components by alternating large and small stars.

Each round points the neighbours of a node at the least of them, first the
larger ones, then the smaller, until nothing changes. A round is joins and
minima: a node with very many neighbours folds in the map tasks, and its rows
can be split in the join. Every round is written to the shared folder, which
keeps the lineage short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake.llm.common import given_back, stored
from vouchlake.operators.keys import same_key


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; the component is its least node.

    It reads one stored table, which ``given_back`` deletes. Edges with a null end or from a node to itself are left out; an empty
    table gives no rows.
    """
    now = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or state.n == 0:
            found = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component"))
            ).distinct()
            found.stored_at = now.stored_at
            return found
        seen = state
        before, now = now, stored(_small_star(_large_star(now)), "edges")
        given_back(before)


def _least(sided: DataFrame) -> DataFrame:
    return sided.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to the least of the node and its neighbours."""
    sided = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(sided)
    return (
        sided.where(F.col("b") > F.col("a"))
        .join(least, same_key(F.col("a"), F.col("node")))
        .select(F.col("b").alias("a"), F.least("least", "a").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of these."""
    joined = edges.join(_least(edges), same_key(F.col("a"), F.col("node")))
    return (
        joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where(F.col("a") != F.col("b"))
        .unionByName(joined.select("a", F.col("least").alias("b")))
        .distinct()
    )
