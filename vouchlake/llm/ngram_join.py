"""Exact Jaccard join of documents on their word n-grams.

1. Every text becomes the set of its n-gram hashes. Documents with equal sets
   fold into the one with the least id.
2. Prefix filter: with n-grams in one order for all documents, two sets that
   reach the similarity share one among their first few. The order puts
   n-grams that many documents hold last, so passages that many share stay out
   of the prefixes. How many hold it is counted over all documents, in a fixed
   number of hash buckets.
3. Documents that share a prefix n-gram meet in tiles, split by size band and,
   where very many meet, into pairs of blocks. Near copies share many n-grams
   and so many tiles; of tiles with the same members one is kept. Within a tile a hashed bitmap of
   each set bounds the overlap from above: every bit set in one map only is at
   least one n-gram the other set lacks. What passes joins two groups; pairs
   inside a group are not looked at again.
4. The groups that are left are tiled again, this time with their whole sets:
   bitmaps first, then the intersection of the sorted arrays. Verified links
   make the components.

Hashes have 64 bits; everything else is exact, and no group is capped. A tile
holds two blocks at most, a group of near copies of ``m`` documents costs ``m``
intersections and not their square, and links are kept as a spanning forest.

Defined cases: without words a set is empty and linked with nothing; null text
is empty; rows that repeat a ``doc_id`` are one node that has the links of all
of them; rows with null ``doc_id`` come back with null component; an empty
table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake.llm.common import given_back, small_batches, stored
from vouchlake.llm.components import connected_components
from vouchlake.llm.picks import impossible, possible
from vouchlake.llm.tiles import dealt, group_blocks, tiled, whole_runs
from vouchlake.llm.words import mix64, ngram_sets
from vouchlake.operators.keys import same_key
from vouchlake.session import ship_package

BUCKETS = 1 << 16  # of the frequency count; bounds what is sent to the tasks
BLOCK_DOCS = 4096  # documents of a block in the bitmap tiles
BLOCK_NGRAMS = 1_000_000  # n-grams of a block in the exact tiles
MAX_BITS = 1 << 13
BATCH_ROWS = 512  # documents, with their texts or n-grams, that a task holds at once
_TILE = ("grp", "band", "low", "high")


def prefix_length(size: int, num: int, den: int) -> int:
    """How many n-grams, in order, are sure to hold one that a similar set shares."""
    return size - -(-num * size // den) + 1


def bitmap(found: np.ndarray) -> np.ndarray:
    """One bit per hash; the width is a power of two at least the size, so maps fold."""
    width = min(max(1 << int(len(found)).bit_length(), 64), MAX_BITS)
    bits = np.zeros(width, dtype=bool)
    bits[(found & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps brought to the least width among them, as rows of 64-bit words."""
    width = min(map(len, maps))
    rows = np.zeros((len(maps), width), dtype=np.uint8)
    for row, one in zip(rows, maps, strict=True):
        np.bitwise_or.reduce(np.frombuffer(one, dtype=np.uint8).reshape(-1, width), axis=0, out=row)
    return rows.view(np.uint64)


def tile_links(sizes: np.ndarray, maps: list[bytes], num: int, den: int, exact=None) -> Iterator[tuple[int, int]]:
    """Pairs that join what is not joined yet, in a tile ordered by size.

    ``exact(i, j)`` gives the size of an intersection; without it the bound
    of the bitmaps decides.
    """
    bits = folded(maps)
    group = np.arange(len(sizes))
    for i in range(len(sizes) - 1):
        # Sizes grow, so those close enough come first.
        end = int(np.searchsorted(sizes, sizes[i] * den // num, side="right"))
        later = np.flatnonzero(group[i + 1 : end] != group[i]) + i + 1
        if not len(later):
            continue
        lacks = np.bitwise_count(bits[i] & ~bits[later]).sum(axis=1)
        lacked = np.bitwise_count(bits[later] & ~bits[i]).sum(axis=1)
        most = np.minimum(sizes[i] - lacks.astype(np.int64), sizes[later] - lacked.astype(np.int64))
        for j in later[den * most >= num * (sizes[i] + sizes[later] - most)].tolist():
            if group[j] == group[i]:
                continue
            if exact is not None:
                shared = exact(i, j)
                if den * shared < num * (int(sizes[i]) + int(sizes[j]) - shared):
                    continue
            group[group == group[j]] = group[i]
            yield i, j


def _bucket(found: np.ndarray, buckets: int) -> np.ndarray:
    return (found >> np.uint64(40)).astype(np.int64) % buckets


def _bucket_counts(docs: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Documents per bucket of n-gram hashes, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            held = [_bucket(found, buckets) for _, found in ngram_sets(batch.column("text"), n)]
            total += np.bincount(np.concatenate(held or [total[:0]]), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, dtype=np.int64)
    for row in rows.toLocalIterator():  # as many rows as there are buckets
        counts[row.bucket] = row.n
    return counts


def ngram_records(docs: DataFrame, n: int, num: int, den: int, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_ngrams, fp1, fp2, prefix, bits)`` of every document."""
    counts = _bucket_counts(docs, n, buckets)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, fp1, fp2, prefixes, maps = [], [], [], [], []
            for _, found in ngram_sets(batch.column("text"), n):
                size = len(found)
                sizes.append(size)
                fp1.append(int(mix64(found).sum(dtype=np.uint64).view(np.int64)) if size else 0)
                fp2.append(int(mix64(found ^ np.uint64(0xABCDEF1234567)).sum(dtype=np.uint64).view(np.int64)) if size else 0)
                held = counts[_bucket(found, buckets)]
                order = np.lexsort((found, held))[: prefix_length(size, num, den)] if size else []
                prefixes.append(found[order].view(np.int64) if size else np.zeros(0, dtype=np.int64))
                maps.append(bitmap(found).tobytes() if size else b"")
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(fp1, pa.int64()),
                    pa.array(fp2, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array(maps, pa.binary()),
                ],
                names=["doc_id", "n_ngrams", "fp1", "fp2", "prefix", "bits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_ngrams long, fp1 long, fp2 long, prefix array<long>, bits binary"
    return docs.select("doc_id", "text").mapInArrow(records, schema)


def _banded(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Each row in the band of its size, and in the next if a similar set can lie there."""
    band = F.floor(F.log2("n_ngrams")).cast("int")
    above = F.pow(F.lit(2), band + 1) * num <= F.col("n_ngrams") * den
    bands = F.when(above, F.array(band, band + 1)).otherwise(F.array(band))
    return rows.withColumn("band", F.explode(bands))


def _links(tiles: DataFrame, keys: list[str], num: int, den: int, exact: bool) -> DataFrame:
    """Spanning links of every tile."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined: dict[int, int] = {}  # what earlier tiles of this task have linked

        def root(x: int) -> int:
            while joined.get(x, x) != x:
                joined[x] = x = joined.get(joined[x], joined[x])
            return x

        for tile in whole_runs(batches, [*keys, "low", "high"]):
            ids = tile.column("doc_id").to_pylist()
            if len({root(x) for x in ids}) == 1:
                continue
            sizes = tile.column("n_ngrams").to_numpy()
            if exact:
                sets = [np.frombuffer(x, dtype=np.uint64) for x in tile.column("grams").to_pylist()]
                maps = [bitmap(s).tobytes() for s in sets]

                def shared(i: int, j: int) -> int:
                    return len(np.intersect1d(sets[i], sets[j], assume_unique=True))

                pairs = tile_links(sizes, maps, num, den, shared)
            else:
                pairs = tile_links(sizes, tile.column("bits").to_pylist(), num, den)
            out = []
            for i, j in pairs:
                a, b = root(ids[i]), root(ids[j])
                if a != b:
                    joined[a], joined[b] = min(a, b), min(a, b)
                    out.append((ids[i], ids[j]))
            if len(joined) > 1_000_000:
                joined.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])

    order = [*keys, "low", "high"]
    dealt = tiles.repartition(*order).sortWithinPartitions(*order, "n_ngrams", "doc_id")
    return dealt.mapInArrow(links, "a long, b long")


def _with_sets(docs: DataFrame, n: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [found.tobytes() for _, found in ngram_sets(batch.column("text"), n)]
            sizes = pa.array([len(g) // 8 for g in grams], pa.int64())
            kept = [batch.column(c) for c in ("doc_id", *_TILE)]
            yield pa.RecordBatch.from_arrays(
                [*kept, sizes, pa.array(grams, pa.binary())], names=["doc_id", *_TILE, "n_ngrams", "grams"]
            )

    return docs.mapInArrow(
        sets, "doc_id long, grp long, band int, low int, high int, n_ngrams long, grams binary"
    )


def _kept_tiles(tiles: DataFrame) -> DataFrame:
    """One of the tiles that hold the same sets; the bitmaps travel for that one only."""
    tile = ["gram", "band", "low", "high"]
    marks = [F.bit_xor(F.xxhash64(F.lit(k), F.col("member"))).alias(f"m{k}") for k in (1, 2)]
    sums = tiles.groupBy(*tile).agg(*marks, F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = sums.groupBy("band", "m1", "m2", "n").agg(F.min(F.struct("gram", "low", "high")).alias("t"))
    return kept.select(F.col("t.gram").alias("k_gram"), F.col("band").alias("k_band"), F.col("t.low").alias("k_low"), F.col("t.high").alias("k_high"))


def _of_tiles(tiles: DataFrame, kept: DataFrame) -> DataFrame:
    same = same_key(F.col("gram"), F.col("k_gram"))
    for c in ("band", "low", "high"):
        same = same & (F.col(c) == F.col(f"k_{c}"))
    return tiles.join(kept, same, "left_semi")


def ngram_components(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``(doc_id, n_ngrams, component_id)``: documents linked from Jaccard ``num / den`` up."""
    ship_package(docs.sparkSession)
    return _components(docs, n, num, den)[0]


def _components(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, list[DataFrame]]:
    """The components, and the stored tables they are read from."""
    # Python runs in here only: what comes back are joins of stored tables.
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return _linked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), n, num, den)


def _known(records: DataFrame) -> DataFrame:
    return records.where((F.col("n_ngrams") > 0) & F.col("doc_id").isNotNull())


def _linked(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, list[DataFrame]]:
    records = stored(ngram_records(docs, n, num, den), "ngram-records")
    first = _known(records).groupBy("fp1", "fp2").agg(F.min(F.struct("doc_id", "n_ngrams", "prefix", "bits")).alias("r"))
    reps = stored(first.select(F.monotonically_increasing_id().alias("member"), "fp1", "fp2", "r.*"), "ngram-sets")
    # Prefixes and bitmaps, most of what is stored, lie there once: of all records, later steps read the rest.
    wide, records = records, stored(records.select("doc_id", "n_ngrams", "fp1", "fp2"), "ngram-ids")
    given_back(wide)
    # What is shuffled for every n-gram of a prefix: the n-gram, the number of its set, the band.
    held = _banded(reps.select("member", "n_ngrams", F.explode("prefix").alias("gram")), num, den).drop("n_ngrams")
    # Stored step by step, so that the shuffles of one step lie on the disk at a time.
    crowded = stored(group_blocks(held, ["gram", "band"], F.lit(1), BLOCK_DOCS), "ngram-crowded")
    tiles = stored(dealt(held, crowded, ["gram", "band"], "member").drop("block"), "ngram-tiles")
    given_back(crowded)
    kept = stored(_kept_tiles(tiles), "ngram-kept")
    all_tiles, tiles = tiles, stored(_of_tiles(tiles, kept), "ngram-tiles")
    given_back(all_tiles, kept)
    maps = reps.select(F.col("member").alias("m_member"), "doc_id", "n_ngrams", "bits")
    mapped = tiles.join(maps, same_key(F.col("member"), F.col("m_member"))).drop("member", "m_member")
    found = connected_components(_links(mapped, ["gram", "band"], num, den, exact=False))
    groups = stored(found.select(F.col("node").alias("g_doc"), F.col("component").alias("grp")), "ngram-groups")
    narrow = stored(reps.select("fp1", "fp2", "doc_id", "n_ngrams"), "ngram-sets")
    given_back(tiles, found, reps)
    reps = narrow
    grouped = reps.select("doc_id", "n_ngrams").join(groups, same_key(F.col("doc_id"), F.col("g_doc"))).drop("g_doc")
    tiles = tiled(_banded(grouped, num, den), ["grp", "band"], F.col("n_ngrams"), BLOCK_NGRAMS)
    tiles = tiles.select(F.col("doc_id").alias("t_doc"), *_TILE)
    texts = possible(docs, "doc_id", groups.select("g_doc")).join(tiles, same_key(F.col("doc_id"), F.col("t_doc"))).select("doc_id", *_TILE, "text")
    links = _links(_with_sets(texts, n), ["grp", "band"], num, den, exact=True)
    # Equal sets are links too: an id may stand for several sets.
    linked = connected_components(links.unionByName(_repeated(_known(records), reps)))
    found = linked.select(F.col("node").alias("c_doc"), "component")
    ids = reps.join(found, same_key(F.col("doc_id"), F.col("c_doc")), "left").select(
        F.col("fp1").alias("s_fp1"), F.col("fp2").alias("s_fp2"), F.coalesce("component", "doc_id").alias("component")
    )
    same_set = same_key(F.col("fp1"), F.col("s_fp1")) & (F.col("fp2") == F.col("s_fp2"))
    components = records.join(ids, same_set & (F.col("n_ngrams") > 0), "left").select(
        "doc_id",
        "n_ngrams",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
    given_back(groups)
    return components, [records, reps, linked]


def _repeated(known: DataFrame, reps: DataFrame) -> DataFrame:
    """Links that come from ids with several sets: the least ids of these sets."""
    several = known.groupBy("doc_id").agg(F.min("fp1").alias("l"), F.max("fp1").alias("h")).where("l != h").select(F.col("doc_id").alias("s_doc"))
    theirs = known.join(several, F.col("doc_id") == F.col("s_doc")).select("doc_id", F.col("fp1").alias("x1"), F.col("fp2").alias("x2"))
    least = reps.select("fp1", "fp2", F.col("doc_id").alias("least"))
    return theirs.join(least, (F.col("x1") == F.col("fp1")) & (F.col("x2") == F.col("fp2"))).select(F.col("doc_id").alias("a"), F.col("least").alias("b"))


def first_of_each(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``docs`` without those that are not the least of their component; rows with null id stay."""
    ship_package(docs.sparkSession)
    found, tables = _components(docs, n, num, den)
    later = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("l_id")).distinct()
    later = stored(later, "ngram-later")
    given_back(*tables)
    same = same_key(F.col("d.doc_id"), F.col("l.l_id"))
    kept = possible(docs, "doc_id", later).alias("d").join(later.alias("l"), same, "left_anti")
    return impossible(docs, "doc_id", later).unionByName(kept)
