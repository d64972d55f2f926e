"""Near-duplicate embeddings by NN-descent.

Equal vectors of a label fold into one that counts for all. A neighbour graph
starts from buckets: nodes of a label whose projections on a few random
directions have the same signs meet, in tiles of two blocks. The more signs, the
more often nodes are put into buckets, so that a pair at the threshold misses all
of them with probability ``MISSED``, however large the label. Then the
graph is refined: at every node its neighbours, in both directions, are compared
with each other, as a neighbour of a neighbour is likely a neighbour. A list in
which all entries reach the threshold is saturated and grows. Rounds end when
few edges are fresh.

Edges that reach the threshold make groups. As lists are short, further turns
look for neighbours outside a node's own group, until no two groups are linked.
Within a group links are counted
exactly, in tiles of two blocks, so that a list that is still too short loses
no link and no pair is ever stored; the links found there make the components.

After the last turn a query set is compared with all nodes; while a link of it
is missed, turns go on. ``audit`` measures the share of the links of any query set
that a result counts.

Defined cases: vectors null, zero, or with null or non-finite components and
rows with null label link with nothing; vectors of different dimensions do not
link; rows that repeat a ``vec_id`` are one (the least usable vector and
label); a row with null id comes back with no links; an empty table gives no rows.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouchlake.llm.common import stored
from vouchlake.llm.components import connected_components
from vouchlake.llm.tiles import tiled, whole_runs
from vouchlake.llm.vectors import comparable, dimensions, matrix, units, usable
from vouchlake.operators.keys import same_key
from vouchlake.session import ship_package

THRESHOLD = 0.98
NEIGHBOURS = 8
SATURATED = 32  # length of the list of a node whose neighbours all reach the threshold
MISSED = 0.001  # share of the links no bucket may hold; more signs take more tables
MOST_BITS = 20
BUCKET = 256  # nodes of a bucket, about
BLOCK = 512  # nodes of a block
ROUNDS = 4
CHANGED = 0.02  # rounds end when a smaller share of all edges is fresh
AUDITED = 1000  # nodes, about, whose links are looked for among all nodes after each turn
SEED = 20_240_229
LOG = logging.getLogger(__name__)
_EDGES = "a long, b long, sim double"


def _best(a: np.ndarray, b: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` nearest of every ``a``."""
    order = np.lexsort((b, -sims, a))
    a, b, sims = a[order], b[order], sims[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = a[1:] != a[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    keep = np.arange(len(a)) - first < most
    return a[keep], b[keep], sims[keep]


def _shortened(edges: DataFrame, neighbours: int, threshold: float) -> DataFrame:
    """Each node's nearest; more of them while all reach the threshold."""
    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    ranked = edges.groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("rank") <= neighbours) | (F.col("rank") <= SATURATED) & (F.col("sim") >= threshold)).drop("rank")


def _tables(threshold: float) -> np.ndarray:
    """How often nodes are put into buckets, by the number of signs, for a pair at the threshold to meet."""
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** np.arange(1, MOST_BITS + 1)
    return np.concatenate([[1], np.ceil(math.log(MISSED) / np.log1p(-np.minimum(together, 1 - 1e-9)))]).astype(int)


def _first_graph(nodes: DataFrame, neighbours: int, threshold: float, turn: int = 0) -> DataFrame:
    """Neighbours within buckets of like sign pattern, other ones each turn, outside a node's own group."""
    labels = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("size") / BUCKET)), F.lit(0)), F.lit(MOST_BITS)).cast("int")
    labels = labels.select(F.col("label").alias("l_label"), bits.alias("bits"))
    most_bits, tables = MOST_BITS, _tables(threshold)
    most = int(tables.max())

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("unit"))
            bits = batch.column("bits").to_numpy()
            planes = np.random.default_rng([SEED, turn]).standard_normal((most, most_bits, vectors.shape[1]))
            patterns = np.empty((len(vectors), most), dtype=np.int64)
            use = np.arange(most_bits) < bits[:, None]
            for k in range(int(tables[bits].max())):
                patterns[:, k] = (((vectors @ planes[k].T > 0) & use) << np.arange(most_bits)).sum(axis=1) + (k << most_bits)
            ends = np.concatenate([[0], np.cumsum(tables[bits])])
            patterns = patterns[np.arange(most) < tables[bits][:, None]]
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(patterns))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], listed], names=["node", "grp", "label", "unit", "buckets"])

    bucketed = (
        nodes.join(labels, same_key(F.col("label"), F.col("l_label")))
        .select("node", "grp", "label", "unit", "bits")
        .mapInArrow(signed, "node long, grp long, label string, unit array<double>, buckets array<long>")
    )
    placed = bucketed.select("node", "grp", "label", "unit", F.explode("buckets").alias("bucket"))
    # A bucket of any size is compared whole.
    blocks = tiled(placed, ["bucket", "label"], F.lit(1), BLOCK, by="node")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in whole_runs(batches, ["bucket", "label", "low", "high"]):
            n = block.num_rows
            if n < 2:
                continue
            ids, vectors = block.column("node").to_numpy(), matrix(block.column("unit"))
            group = block.column("grp").to_numpy()
            sims = vectors @ vectors.T
            sims[group[:, None] == group[None, :]] = -2
            k = min(neighbours, n - 1)
            at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            near = np.take_along_axis(sims, at, 1).ravel()
            a, b, other = np.repeat(ids, k), ids[at.ravel()], near > -1.5
            yield pa.RecordBatch.from_arrays([pa.array(a[other]), pa.array(b[other]), pa.array(near[other])], names=["a", "b", "sim"])

    keys = ("bucket", "label", "low", "high")
    return _shortened(blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(near, _EDGES), neighbours, threshold)


def _compared(edges: DataFrame, nodes: DataFrame, neighbours: int) -> DataFrame:
    """Edges between neighbours of one node that are nearer than the last on one's list."""
    last = edges.groupBy("a").agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n"))
    # A node may take what is nearer than the last on its list, or anything while that is short.
    bound = F.when(F.col("n") < neighbours, F.lit(-2.0)).otherwise(F.col("least"))
    known = last.join(nodes.select("node", "grp", "unit"), same_key(F.col("a"), F.col("node"))).select("node", "grp", "unit", bound.alias("bound"))
    order = Window.partitionBy("b").orderBy(F.desc("sim"), "a")
    back = edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SATURATED)
    both = edges.select(F.col("a").alias("at"), F.col("b").alias("m")).unionByName(
        back.select(F.col("b").alias("at"), F.col("a").alias("m"))
    )
    joined = both.distinct().join(known, same_key(F.col("m"), F.col("node"))).select("at", "node", "grp", "unit", "bound")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in whole_runs(batches, ["at"]):
            if run.num_rows < 2:
                continue
            ids, vectors, bound = run.column("node").to_numpy(), matrix(run.column("unit")), run.column("bound").to_numpy()
            group = run.column("grp").to_numpy()
            sims = vectors @ vectors.T
            sims[group[:, None] == group[None, :]] = -3
            a, b = np.nonzero(sims > bound[:, None])
            if len(a):
                a, b, near = _best(a, b, sims[a, b], neighbours)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b]), pa.array(near)], names=["a", "b", "sim"])

    return joined.repartition("at").sortWithinPartitions("at").mapInArrow(compare, _EDGES)


def neighbour_graph(
    nodes: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, rounds: int = ROUNDS, turn: int = 0
) -> DataFrame:
    """``(a, b, sim)``: for every node ``(node, grp, label, unit)`` its nearest found of the same label in other groups."""
    edges = stored(_first_graph(nodes, neighbours, threshold, turn), "neighbours")
    for _ in range(rounds):
        nearer = stored(_compared(edges, nodes, neighbours), "nearer")
        before, edges = edges, stored(_shortened(edges.unionByName(nearer), neighbours, threshold), "neighbours")
        # Fresh edges of any nearness count: lists that still change lead on to links.
        if edges.join(before, ["a", "b"], "left_anti").count() <= CHANGED * edges.count():
            break
    return edges


def _missed(grouped: DataFrame, threshold: float, turn: int) -> DataFrame:
    """Links of a query set that lead out of their group, one for each other group and batch, and the counts of all.

    The query set are the nodes with the lowest hashes of the turn, about
    ``AUDITED`` of them, or all if there are not more. They are compared with
    every node. Rows are ``(a, b, there, found)``: a link ``a, b``, or numbers of
    links that there are and of those inside a group.
    """
    share = min(1.0, AUDITED / max(grouped.count(), 1))
    asked = grouped.where(F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30))))
    asked = asked.select("node", "grp", "label", "unit").toArrow()  # about AUDITED rows
    ids, groups, labels = (asked[c].to_numpy() for c in ("node", "grp", "label"))
    queries = matrix(asked["unit"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows if len(ids) else 0, 4 * BLOCK):
                part = batch.slice(first, 4 * BLOCK)
                node, grp, label = (part.column(c).to_numpy(zero_copy_only=False) for c in ("node", "grp", "label"))
                q, at = np.nonzero(queries @ matrix(part.column("unit")).T >= threshold)
                linked = (labels[q] == label[at]) & (ids[q] != node[at])
                q, at = q[linked], at[linked]
                out = groups[q] != grp[at]
                _, one = np.unique(np.stack([q[out], grp[at][out]]), axis=1, return_index=True)
                a, b, n = ids[q[out][one]], node[at[out][one]], len(one)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*a.tolist(), None], pa.int64()),
                        pa.array([*b.tolist(), None], pa.int64()),
                        pa.array([None] * n + [len(q)], pa.int64()),
                        pa.array([None] * n + [int((~out).sum())], pa.int64()),
                    ],
                    names=["a", "b", "there", "found"],
                )

    return stored(grouped.select("node", "grp", "label", "unit").mapInArrow(links, "a long, b long, there long, found long"), "audit")


def link_groups(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(node, grp, label, unit, times)``: nodes that links connect have one group.

    A list of partners is short, and a tight family fills it with its own. So
    turns follow in which nodes of one group do not count as partners: every
    group then looks for others only, and they are joined until a turn, with
    buckets of its own, finds no link between two groups and the audit of its
    query set misses none. What the audit finds is kept, and the next turn
    refines its graph and asks for other nodes.
    """
    grouped = nodes.withColumn("grp", F.col("node"))
    known, turn, refine = None, 0, True
    while True:
        graph = neighbour_graph(grouped, threshold, rounds=ROUNDS if refine else 0, turn=turn)
        links = graph.where(F.col("sim") >= threshold).select("a", "b")
        refine = False
        if links.isEmpty():
            audited = _missed(grouped, threshold, turn)
            n = audited.agg(F.sum("there").alias("there"), F.sum("found").alias("found")).first()
            LOG.info("turn %d: %s of %s links of the query set are found", turn, n.found, n.there)
            links, refine = audited.where(F.col("a").isNotNull()).select("a", "b"), True
            if links.isEmpty():
                return grouped
        known = stored(connected_components(links if known is None else known.unionByName(links)), "link-groups")
        known = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
        at = known.select(F.col("a").alias("g_node"), F.col("b").alias("component"))
        joined = nodes.join(at, same_key(F.col("node"), F.col("g_node")), "left")
        grouped = stored(joined.select("node", F.coalesce("component", "node").alias("grp"), "label", "unit", "times"), "grouped-nodes")
        turn += 1


def _grouped_links(members: DataFrame, threshold: float) -> DataFrame:
    """``(node, links, least)`` within groups ``(grp, node, unit, times)``, counted in tiles, and the links as a forest."""
    tiles = tiled(members, ["grp"], F.lit(1), BLOCK, by="node")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in whole_runs(batches, ["grp", "low", "high"]):
            ids, times, vectors = tile.column("node").to_numpy(), tile.column("times").to_numpy(), matrix(tile.column("unit"))
            low, high = tile.column("low")[0].as_py(), tile.column("high")[0].as_py()
            linked = vectors @ vectors.T >= threshold
            np.fill_diagonal(linked, False)
            forest = _forest(linked)
            if low != high:  # links inside a block are counted in the tile of that block alone
                block = tile.column("block").to_numpy()
                linked &= block[:, None] != block[None, :]
            links = linked @ times
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[forest])], names=["node", "links", "other"])

    order = ("grp", "low", "high")
    rows = tiles.select("grp", "low", "high", "block", "node", "times", "unit")
    return rows.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(count, "node long, links long, other long")


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each row one it is connected with: the first of its component."""
    first = np.full(len(linked), -1)
    for root in range(len(linked)):
        if first[root] >= 0:
            continue
        reached = np.zeros(len(linked), dtype=bool)
        new = np.array([root])
        while len(new):
            reached[new] = True
            new = np.flatnonzero(linked[new].any(axis=0) & ~reached)
        first[reached] = root
    return first


def prepared(rows: DataFrame, dim: int | None = None) -> DataFrame:
    """``(vec_id, label, unit)``: the vectors of one dimension that can be compared, one for each id.

    Without ``dim`` all vectors must have one.
    """
    named = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    known = named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    single = known.groupBy("vec_id").agg(F.min(F.struct("embedding", "label")).alias("r")).select("vec_id", "r.*")
    if dim is not None:
        single = comparable(single, dim)

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = units(matrix(batch.column("embedding"))) if batch.num_rows else np.zeros((0, 1))
            ends = pa.array(np.arange(0, vectors.size + 1, max(vectors.shape[1], 1)), pa.int32())
            listed = pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], listed], names=["vec_id", "label", "unit"])

    return single.select("vec_id", "label", "embedding").mapInArrow(unit, "vec_id long, label string, unit array<double>")


def vector_components(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each vector of ``(vec_id, label, embedding)``."""
    ship_package(rows.sparkSession)
    each = rows.sparkSession.createDataFrame([], "e_id long, n_links long, component_id long")
    for dim in dimensions(rows):
        each = each.unionByName(_linked(stored(prepared(rows, dim), "vectors"), threshold))
    ids = rows.select(F.col("vec_id").cast("long").alias("vec_id"))
    ids = ids.where(F.col("vec_id").isNotNull()).distinct().unionByName(ids.where(F.col("vec_id").isNull()))
    component: Column = F.coalesce("component_id", "vec_id")
    return ids.join(each, F.col("vec_id") == F.col("e_id"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _linked(vectors: DataFrame, threshold: float) -> DataFrame:
    """``(e_id, n_links, component_id)`` of prepared vectors of one dimension."""
    folded = vectors.groupBy("label", "unit").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("times"))
    nodes = stored(folded.select("node", "label", "unit", "times"), "vector-nodes")
    members = link_groups(nodes, threshold).select("grp", "node", "unit", "times")
    counted = stored(_grouped_links(members, threshold), "vector-links")
    parts = connected_components(counted.select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    found = (
        nodes.join(links.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left")
        .join(parts.select(F.col("node").alias("p_node"), "component"), F.col("node") == F.col("p_node"), "left")
        .select(
            F.col("label").alias("f_label"),
            F.col("unit").alias("f_unit"),
            (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    same = same_key(F.col("unit"), F.col("f_unit")) & (F.col("label") == F.col("f_label"))
    return vectors.join(found, same).select(F.col("vec_id").alias("e_id"), "n_links", "component_id")


def audit(rows: DataFrame, found: DataFrame, queries: Column, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Links that the result counts for the query rows, and links there are, from a comparison with all rows.

    Both sides meet in blocks; the query set is stated by the caller.
    """
    ship_package(rows.sparkSession)
    counts = [_audited(stored(prepared(rows, dim), "audit-vectors"), found, queries, threshold) for dim in dimensions(rows)]
    return sum(hit for hit, _ in counts), sum(n for _, n in counts)


def _audited(vectors: DataFrame, found: DataFrame, queries: Column, threshold: float) -> tuple[int, int]:
    asked = vectors.where(queries)
    sides = []
    for side, part in (("q", asked), ("r", vectors)):
        blocks = max(1, -(-part.count() // BLOCK))
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
        sides.append((part.withColumn(f"{side}_block", block), blocks))
    (left, n), (right, m) = sides
    left = left.withColumn("r_block", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    right = right.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    def links(a: pa.Table, b: pa.Table) -> pa.Table:
        total = np.zeros(a.num_rows, dtype=np.int64)
        if a.num_rows and b.num_rows:
            near = matrix(a["unit"]) @ matrix(b["unit"]).T >= threshold
            label = np.array(a["label"].to_pylist())[:, None] == np.array(b["label"].to_pylist())[None, :]
            other = a["vec_id"].to_numpy()[:, None] != b["vec_id"].to_numpy()[None, :]
            total = (near & label & other).sum(axis=1)
        return pa.table({"vec_id": a["vec_id"], "links": pa.array(total, pa.int64())})

    keys = ("q_block", "r_block")
    there = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(links, "vec_id long, links long")
    there = there.groupBy("vec_id").agg(F.sum("links").alias("links"))
    both = there.join(found.select("vec_id", "n_links"), "vec_id").agg(
        F.coalesce(F.sum(F.least("n_links", "links")), F.lit(0)).alias("hit"), F.coalesce(F.sum("links"), F.lit(0)).alias("all")
    )
    row = both.first()
    return int(row.hit), int(row["all"])
