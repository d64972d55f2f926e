"""The manifest against a plain Merkle tree, and on what a table can hold."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from vouchlake.llm import merkle, queries, ranks

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest int, rank int, path string, _tie int"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return digest([told(row["doc_id"]), told(row["source"]), told(row["lang"]), told(row["n_chars"]), told(text)])


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def proof(levels, at):
    steps = []
    for level in levels[:-1]:
        run = level[at // 3 * 3 : at // 3 * 3 + 3]
        steps.append((at % 3, run[: at % 3] + run[at % 3 + 1 :]))
        at //= 3
    return steps


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = levels_over([leaf(r, r["text"]) for r in by_source[s]])
    top = levels_over([trees[s][-1][0] for s in sources])
    found = []
    for n, s in enumerate(sources):
        for k, row in enumerate(by_source[s]):
            steps, text, given = proof(trees[s], k) + proof(top, n), row["text"], row["doc_id"]
            if given is not None and text is not None and zlib.crc32(str(given).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(row, text)
            for at, siblings in steps:
                folded = digest([*siblings[:at], folded, *siblings[at:]])
            sibling_digest = digest([d for _, siblings in steps for d in siblings])
            found.append((given, trees[s][0][k], trees[s][-1][0], top[-1][0], sibling_digest, folded, folded == top[-1][0]))
    return sorted(found, key=repr)


def odd_documents(n):
    rng = random.Random(7)
    rows = [(k, f"text {k}\nof it", "en", rng.choice("aaaab"), k, "t", 1, 2, "p", 3) for k in range(n)]
    rows += [
        (None, None, None, None, None, "t", 1, 2, "p", 3),
        (None, "", None, None, 0, "t", 1, 2, "p", 3),
        *[(None, "same", "en", "a", 4, "t", 1, 2, "p", 3)] * 7,
        *[(5, "again\n", "en", "a", 6, "t", 1, 2, "p", 3)] * 2,
        (5, "again", "en", "a", 6, "t", 1, 2, "p", 3),
        (-9, "ümlaut ☃ 𝄞\n", "de", "only one", 11, "t", 1, 2, "p", 3),
        (10**15, "long words\n" * 200_000, "de", "Z", None, "t", 1, 2, "p", 3),
        (77, "x", "de", "", 1, "t", 1, 2, "p", 3),
    ]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1, 2, 6])
def test_proofs_are_those_of_a_plain_tree(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "SPAN", merkle.ARITY**block)
    docs = spark.createDataFrame(odd_documents(60), SCHEMA).repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op13_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)
    assert got == plain([r.asDict() for r in docs.collect()])


def test_records_are_found_by_content(spark):
    leaves = merkle.document_leaves(spark.createDataFrame(odd_documents(40), SCHEMA))
    manifest = merkle.commit(leaves)
    for records in manifest.records:
        for row in records.collect():
            assert row.levels == 0 or any(n.digest == row.top for n in row.nodes)
            assert all(digest(n.children) == n.digest and 1 <= len(n.children) <= 3 for n in row.nodes)


def test_some_requests_get_the_proofs_all_of_them_get(spark):
    leaves = merkle.document_leaves(spark.createDataFrame(odd_documents(40), SCHEMA)).cache()
    manifest = merkle.commit(leaves)
    none = F.array().cast("array<struct<at:int,siblings:array<string>>>").alias("path")
    start = manifest.roots.select("tree", "top", "height", none, F.col("top").alias("root"), F.col("top").alias("subroot"))
    everything = {(r.tree, r.rank): r for r in merkle.prove(leaves.select("tree", "rank"), manifest, start).collect()}
    some = merkle.prove(leaves.where("rank % 5 = 1").select("tree", "rank"), manifest, start).collect()
    assert some and all(r == everything[r.tree, r.rank] for r in some) and len(everything) == leaves.count()
    assert {(r.tree, r.rank): r.digest for r in leaves.collect()} == {k: r.digest for k, r in everything.items()}
    leaves.unpersist()


def test_nothing_gives_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op13_merkle_manifest(spark, str(tmp_path)).collect() == []


def test_ranks_of_a_group_over_many_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", None, "b", "c"]), rng.randrange(50)) for _ in range(3000)] + [("hot", 7)] * 500
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranks.ranked(spark.createDataFrame(rows, "g string, v int").repartition(7), ["g"], ["v"], "test-ranks").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g in {g for g, _ in rows}:
        values = sorted(v for h, v in rows if h == g)
        assert [r.v for r in sorted((r for r in got if r.g == g), key=lambda r: r["rank"])] == values
        assert sorted(r["rank"] for r in got if r.g == g) == list(range(len(values)))
