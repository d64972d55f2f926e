"""The prefix trie of conversations, from sorted sequences and their common prefixes.

Conversations are sequences of turns. Sorted, all that share a prefix stand in
one run, and the least of the common prefix lengths between neighbours tells
how far a run reaches. Chunk by chunk of the sorted rows, a sparse table
answers such range minima, and every prefix of every row finds the left and
the right end of its run by binary search on its own. What a node needs then
comes from differences of prefix sums over the rows of its run:

* a leaf ends at a row that the next row neither repeats nor continues;
* the words that sharing saves below a node are, for each row but the first,
  the words of the part shared with the row before it, less the words above
  the node.

Runs that leave their chunk are kept as partial nodes; their sums, and the ids
that end in them in sorted order, are put together per node afterwards, row by
row and without holding a node's ids. A partition knows nothing of its
neighbours, so it counts its first and last row as if they had none; one row
per partition edge later corrects that along the prefix the two rows share.

A turn is known by 128 bits of hash over its place, role and text; the digest
of a prefix is the exclusive or of its turns. Turns are numbered by ranges
(``ranks.py``), and a conversation is cut into segments of ``DEPTH`` turns,
each a row, so no conversation is held whole. The segments of one depth are
one pass, deepest first: the passes grow with the longest conversation
only, and one covers all up to ``DEPTH`` turns.

``shared_prefixes`` first rebuilds conversations: each takes its first turns
from the first conversation of its group.

Defined cases: null role or text counts as empty. Turns of one number go by
the MD5 of byte count of role, colon, role and text; a null number comes
first. Rows without conversation id take no part. A conversation left without turns is
a member of the root. Texts are hashed whole, however long. An empty table has
no root and gives no rows. Columns other than the four take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vouchlake.llm.common import stored, word_count
from vouchlake.llm.ranks import ranked
from vouchlake.operators.keys import same_key
from vouchlake.session import ship_package

GROUP = 20  # conversations that may share their beginning
SHARED = 3  # turns taken over, at most
DEPTH = 1024  # turns of a segment
CHUNK_TURNS = 100_000
CLOSED, OPEN, VIRTUAL, EDGE = range(4)
_NODES = (
    "kind int, depth long, k1 long, k2 long, p1 long, p2 long, n long, least long, n_ends long, base long, children long"
    ", leaves long, saved long, ends string, parent_least long, part int, chunk int"
)
_EDGES = "last boolean, seg int, c1 long, c2 long, final boolean, x1 binary, x2 binary, words binary"


# -- conversations ------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, digest, words, rank)``: the turns of each conversation, from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", digest.alias("digest"), word_count().alias("words"))
    return ranked(turns, ["conv_id"], ["turn", "digest"], "trie-turns").drop("turn")


def rebuilt(turns: DataFrame, group: int = GROUP, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """The turns ``(conv_id, pos, digest, words)`` with beginnings taken over, and the ids left without any."""
    heads = turns.where(F.col("rank") <= shared).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "digest", "words"))).alias("head")
    )
    heads = stored(heads, "trie-heads")
    taken = F.crc32(F.col("o.conv_id").cast("string")) % (shared + 1)
    base = F.col("o.conv_id") - F.col("o.conv_id") % group
    plan = heads.alias("o").join(heads.alias("b"), base == F.col("b.conv_id"), "left").select(
        "o.conv_id",
        taken.alias("taken"),
        F.coalesce(F.slice("b.head", F.lit(1), taken.cast("int")), F.array().cast(heads.schema["head"].dataType)).alias("given"),
        F.size("o.head").alias("own"),
    )
    plan = stored(plan, "trie-plan")
    given = plan.select("conv_id", F.posexplode("given").alias("pos", "turn")).select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "turn.digest", "turn.words"
    )
    sizes = plan.select("conv_id", "taken", F.size("given").alias("n_given"))
    own = turns.alias("t").join(sizes.alias("p"), same_key(F.col("t.conv_id"), F.col("p.conv_id"))).where(F.col("rank") >= F.col("taken"))
    own = own.select("t.conv_id", (F.col("rank") - F.col("taken") + F.col("n_given")).alias("pos"), "digest", "words")
    bare = plan.where((F.size("given") == 0) & (F.col("own") <= F.col("taken"))).select("conv_id")
    return given.unionByName(own), bare


def _segments(turns: DataFrame, bare: DataFrame, depth: int) -> DataFrame:
    """One row per ``depth`` turns: the hashes of its turns and those of all before it."""
    at = [F.xxhash64(F.lit(k), F.col("pos"), F.col("digest")).alias(f"x{k}") for k in (1, 2)]
    hashed = turns.select("conv_id", "pos", *at, "words").withColumn("seg", F.floor(F.col("pos") / depth).cast("int"))
    segments = hashed.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("pos", "x1", "x2", "words"))).alias("turns"), F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2")
    )
    segments = stored(segments, "trie-segments")
    alone = (F.col("seg") == 0) & (F.size("turns") < depth)
    before = Window.partitionBy("conv_id").orderBy("seg")
    above = before.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    whole = segments.where(alone).select("conv_id", "seg", "turns", zero.alias("c1"), zero.alias("c2"), F.lit(True).alias("final"))
    cut = segments.where(~alone).select(
        "conv_id",
        "seg",
        "turns",
        *[F.coalesce(F.bit_xor(f"t{k}").over(above), zero).alias(f"c{k}") for k in (1, 2)],
        F.lead("seg").over(before).isNull().alias("final"),
    )
    none = F.array().cast(segments.schema["turns"].dataType)
    empty = bare.select("conv_id", F.lit(0).alias("seg"), none.alias("turns"), zero.alias("c1"), zero.alias("c2"), F.lit(True).alias("final"))
    return whole.unionByName(cut).unionByName(empty)


# -- chunks of sorted rows ----------------------------------------------------


class _Rows:
    """Consecutive sorted rows as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        def plain(name: str) -> np.ndarray:
            return batch.column(name).to_numpy(zero_copy_only=False)

        self.size = batch.num_rows
        self.seg, self.c1, self.c2 = plain("seg"), plain("c1"), plain("c2")
        self.final, self.conv = plain("final"), plain("conv_id")
        self.more_leaves, self.more_saved = plain("more_leaves"), plain("more_saved")
        self.length = batch.column("x1").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.x1, self.x2, self.words = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("x1", "x2", "words"))

    def row(self, i: int) -> dict:
        part = slice(self.start[i], self.start[i] + self.length[i])
        return {
            "seg": int(self.seg[i]), "c1": int(self.c1[i]), "c2": int(self.c2[i]), "final": bool(self.final[i]),
            "x1": self.x1[part], "x2": self.x2[part], "words": self.words[part],
        }

    def common(self) -> np.ndarray:
        """Common prefix length of each row with the one before it; -1 where not even the start is common."""
        out = np.full(self.size, -1, dtype=np.int64)
        same = (self.seg[1:] == self.seg[:-1]) & (self.c1[1:] == self.c1[:-1]) & (self.c2[1:] == self.c2[:-1])
        live, depth = np.flatnonzero(same) + 1, 0
        out[live] = 0
        least = np.minimum(self.length, np.concatenate([[0], self.length[:-1]]))
        while len(live):
            live = live[least[live] > depth]
            a, b = self.start[live] + depth, self.start[live - 1] + depth
            live = live[(self.x1[a] == self.x1[b]) & (self.x2[a] == self.x2[b])]
            depth += 1
            out[live] = depth
        return out


def common_prefix(a: dict, b: dict) -> int:
    """The same for two rows."""
    if any(a[c] != b[c] for c in ("seg", "c1", "c2")):
        return -1
    n = min(len(a["x1"]), len(b["x1"]))
    differ = np.flatnonzero((a["x1"][:n] != b["x1"][:n]) | (a["x2"][:n] != b["x2"][:n]))
    return int(differ[0]) if len(differ) else n


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima over the ``2 ** k`` values from each place."""
    table = [values]
    while (1 << len(table)) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def extents(common: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of the run that shares ``depth`` turns with ``row``, by binary search for each.

    ``common[i]`` is the common prefix length of rows ``i`` and ``i + 1``.
    """
    left, right, last = row.copy(), row.copy(), len(common)
    for k in reversed(range(len(table := sparse_table(common)))):
        step, minima = 1 << k, table[k]
        if not len(minima):
            continue
        ok = (right + step <= last) & (minima[np.minimum(right, len(minima) - 1)] >= depth)
        right[ok] += step
        ok = (left >= step) & (minima[np.maximum(left - step, 0)] >= depth)
        left[ok] -= step
    return left, right


def _prefix_xor(first: np.ndarray, values: np.ndarray, begin: np.ndarray, inner: np.ndarray, owner: np.ndarray) -> np.ndarray:
    flat = np.empty(len(owner), dtype=np.int64)
    flat[begin], flat[inner] = first, values
    total = np.bitwise_xor.accumulate(flat)
    return total ^ np.where(begin > 0, total[begin - 1], 0)[owner]


def _nodes(rows: _Rows, before: int | None, after: int | None, whole: int, part: int, chunk: int) -> list[np.ndarray]:
    """The nodes of a chunk; ``before`` and ``after`` are common prefixes over its ends, None if not known.

    ``whole`` is the length of a segment that goes on.
    """
    common = rows.common()
    common[0] = -1 if before is None else before
    following = np.append(common[1:], -1 if after is None else after)
    owner = np.repeat(np.arange(rows.size), rows.length + 1)
    begin = rows.start + np.arange(rows.size)
    depth = np.arange(len(owner)) - begin[owner]
    inner = np.flatnonzero(depth)
    k1 = _prefix_xor(rows.c1, rows.x1, begin, inner, owner)
    k2 = _prefix_xor(rows.c2, rows.x2, begin, inner, owner)
    above = np.zeros(len(owner), dtype=np.int64)
    above[inner] = rows.words
    above = np.cumsum(above)
    above -= above[begin][owner]  # words up to each depth

    left, right = extents(common[1:], owner, depth)
    at = np.flatnonzero(left == owner)  # each node once, where its run begins
    number = np.cumsum(left == owner) - 1
    low, high, d = owner[at], right[at], depth[at]
    n = high - low + 1
    inside = d > 0
    parent = np.full(len(at), -1)
    parent[inside] = number[begin[left[at[inside] - 1]] + d[inside] - 1]
    first = (low > 0) | (d > common[0])  # whether the run begins in this chunk
    children = np.bincount(parent[inside & first], minlength=len(at))
    ending = np.flatnonzero(rows.final)
    end = begin[ending] + rows.length[ending]
    n_ends = np.bincount(number[begin[left[end]] + rows.length[ending]], minlength=len(at))

    def summed(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[high + 1] - total[low]

    leaves = summed((rows.final & (rows.length > following)) + rows.more_leaves)
    shared = np.where(common >= 0, above[begin + np.maximum(common, 0)], 0)
    saved = summed(shared) - np.where(first, shared[low], 0) + summed(rows.more_saved)
    base = np.where(inside, above[np.maximum(at - 1, 0)], 0)

    table = sparse_table(rows.conv)
    power = np.frexp(n)[1] - 1
    least = np.empty(len(at), dtype=np.int64)
    for k in range(len(table)):
        of = power == k
        least[of] = np.minimum(table[k][low[of]], table[k][high[of] - (1 << k) + 1])

    seg = rows.seg[low].astype(np.int64)
    open_left = (low == 0) & ((before is None) | (d <= common[0]))
    open_right = (high == rows.size - 1) & ((after is None) | (d <= following[-1]))
    is_open = open_left | open_right | (d == whole) | (d == 0)
    kind = np.where(is_open, np.where((d == 0) & (seg > 0), VIRTUAL, OPEN), CLOSED)
    saved = np.where(is_open, saved, saved - (n - 1) * base)
    ends: list[str | None] = [None] * len(at)
    for k in np.flatnonzero((n_ends > 0) | ~is_open):
        ids = ",".join(map(str, rows.conv[low[k] : low[k] + n_ends[k]].tolist()))
        ends[k] = ids if is_open[k] else hashlib.sha256(ids.encode()).hexdigest()
    known = inside & ~is_open[parent]
    same = [np.full(len(at), part, dtype=np.int32), np.full(len(at), chunk, dtype=np.int32)]
    columns = [kind.astype(np.int32), seg * whole + d, k1[at], k2[at]]
    arrays = [pa.array(c) for c in columns]
    arrays += [pa.array(k[np.maximum(at - 1, 0)], mask=~inside) for k in (k1, k2)]
    arrays += [pa.array(c) for c in (n, least, n_ends, base, children, leaves, saved)]
    arrays += [pa.array(ends, pa.string()), pa.array(least[parent], mask=~known), *[pa.array(c) for c in same]]
    return arrays


def _edge_names() -> list[str]:
    return [f.split()[0] for f in _EDGES.split(", ")]


def _names() -> list[str]:
    return [f.split()[0] for f in _NODES.split(", ")]


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[_Rows]:
    for batch in batches:
        turns = np.cumsum(batch.column("x1").value_lengths().to_numpy(zero_copy_only=False) + 1)
        begin = 0
        while begin < batch.num_rows:
            used = turns[begin - 1] if begin else 0
            end = max(int(np.searchsorted(turns, used + most, side="right")), begin + 1)
            yield _Rows(batch.slice(begin, end - begin))
            begin = end


_EDGE_TYPES = [pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]


def _edge(row: dict, last: bool, part: int) -> pa.RecordBatch:
    """The first or the last row of a partition."""
    held = [last, row["seg"], row["c1"], row["c2"], row["final"], *(row[c].tobytes() for c in ("x1", "x2", "words"))]
    types = [pa.int32(), *[pa.int64()] * 12, pa.string(), pa.int64(), pa.int32(), pa.int32()]
    given = {"kind": EDGE, "part": part}
    arrays = [pa.array([given.get(name)], t) for name, t in zip(_names(), types, strict=True)]
    arrays += [pa.array([v], t) for v, t in zip(held, _EDGE_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[*_names(), *_edge_names()])


def _find_nodes(whole: int, most: int):
    """The nodes of sorted segments of at most ``whole`` turns, by chunks of about ``most`` turns."""

    def out(rows: _Rows, before: int | None, after: int | None, part: int, chunk: int) -> pa.RecordBatch:
        arrays = _nodes(rows, before, after, whole, part, chunk)
        none = [pa.nulls(len(arrays[0]), t) for t in _EDGE_TYPES]
        return pa.RecordBatch.from_arrays([*arrays, *none], names=[*_names(), *_edge_names()])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, before, chunk = None, None, 0
        for rows in _chunks(batches, most):
            if held is None:
                yield _edge(rows.row(0), False, part)
            else:
                over = common_prefix(held.row(held.size - 1), rows.row(0))
                yield out(held, before, over, part, chunk)
                before, chunk = over, chunk + 1
            held = rows
        if held is not None:
            yield _edge(held.row(held.size - 1), True, part)
            yield out(held, before, None, part, chunk)

    return find


# -- over the edges -----------------------------------------------------------


def _corrections(whole: int):
    """What partitions counted wrong at their edges: rows to add to the nodes on the shared prefix."""

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, previous = _names(), None
        for batch in batches:
            for row in batch.to_pylist():
                row |= {c: np.frombuffer(row[c], dtype=np.int64) for c in ("x1", "x2", "words")}
                if row["last"]:
                    previous = row
                    continue
                over = -1 if previous is None else common_prefix(previous, row)
                if over < 0:
                    continue
                ended = previous["final"] and len(previous["x1"]) == over
                depth = np.arange(over + 1)
                keys = [np.bitwise_xor.accumulate(np.concatenate([[row[f"c{k}"]], row[f"x{k}"][:over]])) for k in (1, 2)]
                zero, none = np.zeros(over + 1, dtype=np.int64), pa.nulls(over + 1, pa.int64())
                kind = np.where((depth == 0) & (row["seg"] > 0), VIRTUAL, OPEN).astype(np.int32)
                saved = np.full(over + 1, int(row["words"][:over].sum()))
                parts = [pa.array(np.full(over + 1, row["part"], dtype=np.int32)), pa.array(np.full(over + 1, -1, dtype=np.int32))]
                arrays = [pa.array(c) for c in (kind, row["seg"] * whole + depth, *keys)]
                arrays += [none, none, pa.array(zero), none, pa.array(zero), pa.array(zero)]
                arrays += [pa.array(c) for c in (-(depth < over).astype(np.int64), zero - int(ended), saved)]
                arrays += [pa.nulls(over + 1, pa.string()), none, *parts]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return correct


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial rows, sorted by node and then by place, to one row per node; ids pass one piece at a time."""
    names = [n for n in _names() if n not in ("kind", "part", "chunk")]
    types = [pa.string() if n == "ends" else pa.int64() for n in names]
    done: list[tuple] = []
    node: dict | None = None

    def close(node: dict) -> tuple:
        digest = node["hash"].hexdigest()
        saved = node["saved"] - (node["n"] - 1) * node["base"]
        return tuple(digest if n == "ends" else saved if n == "saved" else node[n] for n in names)

    for batch in batches:
        for row in batch.to_pylist():
            key = (row["depth"], row["k1"], row["k2"])
            if node is None or (node["depth"], node["k1"], node["k2"]) != key:
                if node is not None:
                    done.append(close(node))
                node = {"depth": row["depth"], "k1": row["k1"], "k2": row["k2"], "p1": None, "p2": None, "least": None, "parent_least": None, "base": 0}
                node |= dict.fromkeys(("n", "n_ends", "children", "leaves", "saved"), 0) | {"hash": hashlib.sha256()}
            node["children"] += row["children"]
            if row["kind"] == VIRTUAL:  # the rest has come through the segment above
                continue
            for c in ("n", "n_ends", "leaves", "saved"):
                node[c] += row[c]
            node["base"] = max(node["base"], row["base"])
            if row["p1"] is not None:
                node["p1"], node["p2"], node["parent_least"] = row["p1"], row["p2"], row["parent_least"]
            if row["least"] is not None:
                node["least"] = row["least"] if node["least"] is None else min(node["least"], row["least"])
            if row["ends"] is not None:
                node["hash"].update((("," if node.get("any") else "") + row["ends"]).encode())
                node["any"] = True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)
            done = []
    if node is not None:
        done = [close(node)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)


def _pass(segments: DataFrame, seg: int, more: DataFrame | None, whole: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of the segments of one depth, and the corrections to them."""
    rows = segments.where(F.col("seg") == seg)
    if more is None:
        zero = F.lit(0).cast("long")
        rows = rows.withColumn("more_leaves", zero).withColumn("more_saved", zero)
    else:
        rows = rows.join(more, "conv_id", "left").na.fill(0, ["more_leaves", "more_saved"])
    order = ["c1", "c2", "turns", F.col("final").desc(), "conv_id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(
        "seg", "c1", "c2", "final", "conv_id", "more_leaves", "more_saved", *[F.col(f"turns.{c}").alias(c) for c in ("x1", "x2", "words")]
    )
    found = stored(rows.mapInArrow(_find_nodes(whole, CHUNK_TURNS), f"{_NODES}, {_EDGES}"), "trie-nodes")
    # Two rows per partition.
    edges = found.where(F.col("kind") == EDGE).select("part", *_edge_names())
    edges = edges.repartition(1).sortWithinPartitions("part", "last")
    return found.where(F.col("kind") != EDGE).drop(*_edge_names()), stored(edges.mapInArrow(_corrections(whole), _NODES), "trie-edges")


def prefix_nodes(turns: DataFrame, bare: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per distinct prefix of ``(conv_id, pos, digest, words)``, the empty one included."""
    ship_package(turns.sparkSession)
    segments = _segments(turns, bare, depth)
    deepest = turns.agg(F.max("pos")).first()[0] or 0
    nodes = corrections = more = None
    for seg in reversed(range(deepest // depth + 1)):
        found, wrong = _pass(segments, seg, more, depth)
        nodes = found if nodes is None else nodes.unionByName(found)
        corrections = wrong if corrections is None else corrections.unionByName(wrong)
        if seg:
            # What hangs below a whole segment goes to one of the rows that hold it.
            below = found.where(F.col("kind") == VIRTUAL).unionByName(wrong.where(F.col("kind") == VIRTUAL))
            below = below.groupBy("k1", "k2").agg(F.min("least").alias("conv_id"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
            more = stored(below.drop("k1", "k2"), "trie-below")
    parts = nodes.where(F.col("kind") != CLOSED).unionByName(corrections)
    key = ["depth", "k1", "k2"]
    parts = parts.repartition(*key).sortWithinPartitions(*key, "part", "chunk").drop("part", "chunk")
    schema = ", ".join(f for f in _NODES.split(", ") if f.split()[0] not in ("kind", "part", "chunk"))
    merged = stored(parts.mapInArrow(_merge, schema), "trie-merged")
    whole = nodes.where(F.col("kind") == CLOSED).select(merged.columns).unionByName(merged)
    above = merged.select((F.col("depth") + 1).alias("u"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("least").alias("u_least"))
    same = same_key(F.col("p1"), F.col("u1")) & (F.col("p2") == F.col("u2")) & (F.col("depth") == F.col("u"))
    tied = whole.where("parent_least IS NULL").drop("parent_least").join(above, same, "left").withColumnRenamed("u_least", "parent_least")
    return whole.where("parent_least IS NOT NULL").unionByName(tied.select(whole.columns))


def shared_prefixes(conversations: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    nodes = prefix_nodes(*rebuilt(numbered_turns(conversations)), depth)
    return nodes.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("parent_least").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
