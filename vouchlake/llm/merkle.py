"""A Merkle manifest of a dataset: one digest for all rows, and a proof for each.

Every row is a leaf, the digest of its columns. The leaves of a source, in
order of their ids, are hashed by runs of three, level by level, to one
digest; the digests of the sources, in order of the source, likewise to the
root. ``commit`` stores the inner nodes as records from a digest to its
children: a content-addressed graph in which equal subtrees are one record.

``prove`` answers requests for leaves by descent. A request starts at the root
digest, looks its record up, follows the child that the digit of its rank
names and keeps the children not followed; the segments gathered on the way
down are reversed at the end. Records of ``BLOCK`` levels are stored under the
digest at their top, so one lookup serves that many levels, and requests for
leaves below one block travel above it as one. Blocks hold at most
``3 ** BLOCK`` digests whatever the size of a source, so a source with a third
of all rows is many blocks. Tables of one row per block or per leaf are
shuffled, texts never are.

Defined cases: null is told apart from empty text. A null source is a source
of its own, first in order; a null id comes first within its source. Rows
with one id go by their leaf digest; rows equal in all five columns are
leaves of their own with one digest, each with its own proof. A source of one
row is its own subroot, a single source its own root. Whole texts are hashed,
however long. An empty table has no root and no rows. Columns other than the
five take no part and are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchlake.llm.common import stored
from vouchlake.llm.ranks import ranked
from vouchlake.session import ship_package

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
BLOCK = 6  # levels a stored block spans
SPAN = ARITY**BLOCK
_MAX_HEIGHT = 39  # 3 ** 39 leaves are more than a long can count
_STEPS = "array<struct<at:int,siblings:array<string>>>"


class Manifest(NamedTuple):
    roots: DataFrame  # tree, top, height: the digest over each tree and its number of levels
    records: list[DataFrame]  # per span of levels: top, levels, nodes(digest, children)


# -- leaves -----------------------------------------------------------------


def leaf_digest(text: Column, fields: tuple[str, ...] = FIELDS) -> Column:
    """Digest of a row: each column as ``-`` for null, else byte count, colon, value."""

    def told(c: str) -> Column:
        value = text if c == "text" else F.col(f"`{c}`").cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[told(c) for c in fields]), 256)


def document_leaves(docs: DataFrame, *more: Column) -> DataFrame:
    """``(tree, rank, digest, doc_id, more...)``: the leaves of each source, numbered."""
    leaves = docs.select(F.col("source").alias("tree"), "doc_id", leaf_digest(F.col("text")).alias("digest"), *more)
    # Hashed once; the sort moves digests only.
    leaves = stored(leaves, "merkle-leaves")
    return ranked(leaves, ["tree"], ["doc_id", "digest"], "merkle-ranks")


# -- building ---------------------------------------------------------------


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The inner nodes of each block: ``levels`` times every three digests become one."""
    for batch in batches:
        tops, counts, digests, children = [], [], [], []
        for level, levels in zip(batch.column("digests").to_pylist(), batch.column("levels").to_pylist(), strict=True):
            found: dict[str, list[str]] = {}
            for _ in range(levels):
                runs = [level[k : k + ARITY] for k in range(0, len(level), ARITY)]
                level = [_digest(run) for run in runs]
                found.update(zip(level, runs, strict=True))
            tops.append(level[0])
            counts.append(len(found))
            digests.extend(found)
            children.extend(found.values())
        nodes = pa.StructArray.from_arrays(
            [pa.array(digests, pa.string()), pa.array(children, pa.list_(pa.string()))], names=["digest", "children"]
        )
        nodes = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), nodes)
        kept = [batch.column(c) for c in ("tree", "height", "block", "levels")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(tops, pa.string()), nodes], names=["tree", "height", "block", "levels", "top", "nodes"])


def _tall(n: Column) -> Column:
    """Levels above ``n`` nodes."""
    return sum(((n > F.lit(ARITY**k)).cast("int") for k in range(_MAX_HEIGHT)), F.lit(0))


def _block(rank: str = "rank") -> Column:
    return F.floor(F.col(rank) / SPAN).cast("long")


def commit(leaves: DataFrame) -> Manifest:
    """The records and roots of ``(tree, rank, digest)``, ranks from 0 without gaps in each tree."""
    ship_package(leaves.sparkSession)
    sizes = leaves.groupBy("tree").agg(_tall(F.max("rank") + 1).alias("height"))
    sizes = stored(sizes, "merkle-sizes")
    tallest = sizes.agg(F.max("height")).first()[0] or 0
    level = leaves.select("tree", "rank", "digest").alias("n").join(sizes.alias("s"), F.col("n.tree").eqNullSafe(F.col("s.tree")))
    level = level.select("n.tree", "rank", "digest", "height")
    schema = f"tree {leaves.schema['tree'].dataType.simpleString()}, height int, block long, levels int, top string, nodes array<struct<digest:string,children:array<string>>>"
    records, roots, done = [], None, 0
    while True:
        blocks = level.groupBy("tree", "height", _block().alias("block")).agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run"))
        blocks = blocks.select(
            "tree", "height", "block", F.least(F.lit(BLOCK), F.col("height") - done).cast("int").alias("levels"), F.col("run.digest").alias("digests")
        )
        blocks = stored(blocks.mapInArrow(_fold_blocks, schema), "merkle-blocks")
        records.append(blocks.select("top", "levels", "nodes"))
        done += BLOCK
        ready = blocks.where(F.col("height") <= done).select("tree", "top", "height")
        roots = ready if roots is None else roots.unionByName(ready)
        if tallest <= done:
            return Manifest(roots, records)
        level = blocks.where(F.col("height") > done).select("tree", F.col("block").alias("rank"), F.col("top").alias("digest"), "height")


# -- descent ----------------------------------------------------------------


def _flat_lists(lists: list[list], of: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32), of)


def _steps_array(paths: list[list[tuple[int, list[str]]]]) -> pa.Array:
    steps = [s for path in paths for s in path]
    siblings = [s[1] for s in steps]
    held = pa.array([d for some in siblings for d in some], pa.string())
    steps = pa.StructArray.from_arrays([pa.array([s[0] for s in steps], pa.int32()), _flat_lists(siblings, held)], names=["at", "siblings"])
    return _flat_lists(paths, steps)


def _descend(upside_down: bool):
    """Each asked rank of a block, from the block's top to its digest ``levels`` below."""

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("asked")
            lengths = asked.value_lengths().to_numpy(zero_copy_only=False)
            asked = pa.RecordBatch.from_struct_array(asked.flatten())
            ranks, at, found, paths = asked.column("rank").to_pylist(), 0, [], []
            given = [batch.column(c).to_pylist() for c in ("top", "levels", "nodes", "path")]
            for top, levels, nodes, above, length in zip(*given, lengths, strict=True):
                children = {n["digest"]: n["children"] for n in nodes}
                above = [(s["at"], s["siblings"]) for s in above]
                for rank in ranks[at : at + length]:
                    digest, path = top, list(above)
                    for level in reversed(range(levels)):
                        digit = rank // ARITY**level % ARITY
                        run = children[digest]
                        path.append((digit, run[:digit] + run[digit + 1 :]))
                        digest = run[digit]
                    found.append(digest)
                    paths.append(path[::-1] if upside_down else path)
                at += length
            owner = pa.array(np.repeat(np.arange(batch.num_rows), lengths))
            kept = [batch.column(c).take(owner) for c in ("tree", "root", "subroot")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *asked.columns, pa.array(found, pa.string()), _steps_array(paths)],
                names=["tree", "root", "subroot", *asked.schema.names, "digest", "path"],
            )

    return descend


def prove(requests: DataFrame, manifest: Manifest, start: DataFrame) -> DataFrame:
    """``(tree, root, subroot, rank, more..., digest, path)`` for distinct requests ``(tree, rank, more...)``.

    ``start`` holds, for each tree, ``top``, ``height``, the path from above
    it, ``root`` and ``subroot``. ``path`` runs from the leaf to the root: the
    place among its siblings at each level, and the siblings. Further columns
    of the requests come back as they are.
    """
    ship_package(requests.sparkSession)
    more = [c for c in requests.columns if c not in ("tree", "rank")]
    paths = None
    for s in reversed(range(len(manifest.records))):
        begun = start.where((F.col("height") > s * BLOCK) if s else F.lit(True))
        begun = begun.where(F.col("height") <= (s + 1) * BLOCK)
        begun = begun.select("tree", F.lit(0).cast("long").alias("block"), "root", "subroot", "top", "path")
        paths = begun if paths is None else paths.unionByName(begun)
        asked = requests
        if s:
            asked = requests.select("tree", F.floor(F.col("rank") / F.lit(SPAN**s)).cast("long").alias("rank")).distinct()
        carried = [] if s else more
        fields = ", ".join(f"{c} {asked.schema[c].dataType.simpleString()}" for c in ("rank", *carried))
        schema = f"tree {asked.schema['tree'].dataType.simpleString()}, root string, subroot string, {fields}, digest string, path {_STEPS}"
        # At most SPAN requests a block.
        asked = asked.groupBy("tree", _block().alias("block")).agg(F.collect_list(F.struct("rank", *carried)).alias("asked"))
        records = manifest.records[s].dropDuplicates(["top"])
        met = paths.alias("p").join(records.alias("r"), F.col("p.top") == F.col("r.top")).select("p.*", "levels", "nodes")
        met = met.alias("p").join(asked.alias("a"), F.col("p.tree").eqNullSafe(F.col("a.tree")) & (F.col("p.block") == F.col("a.block")))
        met = met.select("p.tree", "root", "subroot", "top", "levels", "nodes", "path", "asked")
        found = met.mapInArrow(_descend(s == 0), schema)
        if s:
            paths = stored(found.select("tree", F.col("rank").alias("block"), "root", "subroot", F.col("digest").alias("top"), "path"), "merkle-paths")
    return found


def document_proofs(leaves: DataFrame) -> DataFrame:
    """Every leaf of ``document_leaves`` with its proof through its source's subroot to the root.

    The digest comes from the descent, so it shows what the manifest holds.
    """
    sources = commit(leaves)
    subroots = sources.roots.select("tree", "height", "top")
    # One row per source.
    tops = ranked(subroots.select(F.lit(0).alias("all"), "tree", F.col("top").alias("digest")), ["all"], ["tree"], "merkle-subroots")
    tops = tops.select(F.col("all").alias("tree"), "rank", "digest", F.col("tree").alias("source"))
    whole = commit(tops)
    none = F.array().cast(_STEPS)
    start = whole.roots.select("tree", "top", "height", none.alias("path"), F.col("top").alias("root"), F.col("top").alias("subroot"))
    above = prove(tops.select("tree", "rank"), whole, start).drop("tree")
    begun = tops.alias("t").join(above.alias("a"), "rank").select(F.col("source").alias("tree"), "root", F.col("a.digest").alias("subroot"), "path")
    begun = begun.alias("b").join(subroots.alias("s"), F.col("b.tree").eqNullSafe(F.col("s.tree")))
    # Paths run upwards; below them the descent goes on downwards.
    begun = begun.select("b.tree", F.col("subroot").alias("top"), "height", F.reverse("path").alias("path"), "root", "subroot")
    return prove(leaves.drop("digest"), sources, stored(begun, "merkle-begun"))


# -- verifying --------------------------------------------------------------


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and a proof lead to."""

    def up(digest: Column, step: Column) -> Column:
        before = F.slice(step["siblings"], F.lit(1), step["at"])
        after = F.slice(step["siblings"], step["at"] + 1, F.lit(ARITY))
        return F.sha2(F.concat(F.array_join(before, ""), digest, F.array_join(after, "")), 256)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda step: step["siblings"])), ""), 256)
