"""The trie of conversations against a plain one, and on what a table can hold."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vouchlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, rank int, digest string, seg int, words string, pos long"


def plain(rows):
    """``rows``: (conv_id, turn, role, text)."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn, role or "", text or ""))

    def key(t):
        return t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).digest()

    own = {c: [t[1:] for t in sorted(ts, key=key)] for c, ts in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = int(np.fix(c / 20)) * 20
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, children = {}, {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
            if d:
                children.setdefault(seq[: d - 1], set()).add(seq[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children.get(node, ())) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children.get(node, ()))
    found = []
    for node, some in members.items():
        ends = sorted(c for c in some if whole[c] == node)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        found.append((min(some), len(node), parent, len(some), len(children.get(node, ())), leaves[node], saved[node], digest))
    return sorted(found, key=repr)


def conversations(n, longest, seed):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for turn in range(rng.choice([1, 2, 3, rng.randrange(1, longest + 1)])):
            # Few texts, so that many prefixes are shared.
            rows.append((c * 3 - 40, turn, rng.choice(["user", "user", "bot"]), rng.choice(["one", "one", "two words", " "])))
    rows += [(c, t, "user", f"the same turn {t} of all") for c in range(1000, 1000 + n) for t in range(4)]
    rows += [(c, t, "bot", f"long {t}") for c in (5000, 5001, 5002, 5003, 5007) for t in range(longest * 3 + (c == 5002))]
    rows += [
        (7000, None, None, None), (7000, None, "", ""), (7000, 1, "user", None), (7000, 1, "user", "x"), (7000, 1, "user", "x"),
        (7001, 5, "us", "erx"), (7001, 6, "user", "x"), (None, 1, "user", "no id"), (None, 1, "user", "no id"),
        (10**15, 1, "user", "very long text " * 100_000), (-(10**15), 0, "ü☃", "𝄞"),
    ]
    rng.shuffle(rows)
    return rows


def got(spark, rows, depth=prefix_trie.DEPTH):
    table = spark.createDataFrame([(*r, 1, "d", 2, "w", 3) for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in prefix_trie.shared_prefixes(table, depth).collect()), key=repr)


@pytest.mark.parametrize("depth", [3, 1024])
def test_nodes_are_those_of_a_plain_trie(spark, depth):
    rows = conversations(120, 7, depth)
    assert got(spark, rows, depth) == plain(rows)


def test_no_rows_no_root(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []
    alone = got(spark, [(0, 0, "user", "a b")])
    assert alone == plain([(0, 0, "user", "a b")]) and len(alone) == 2


def test_a_conversation_left_without_turns_is_in_the_root(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone"), (c + 20, 0, "user", "stays?")]
    assert got(spark, rows) == plain(rows)


def test_extents_by_binary_search():
    rng = np.random.default_rng(2)
    common = rng.integers(0, 4, 200)
    row, depth = np.repeat(np.arange(201), 4), np.tile(np.arange(4), 201)
    left, right = prefix_trie.extents(common, row, depth)
    for r, d, a, b in zip(row, depth, left, right, strict=True):
        while r and common[r - 1] >= d:
            r -= 1
        assert r == a
        while r < 200 and common[r] >= d:
            r += 1
        assert r == b
    assert [x.tolist() for x in prefix_trie.extents(np.zeros(0, dtype=int), np.array([0]), np.array([0]))] == [[0], [0]]


def test_any_cut_into_chunks_gives_the_same(spark, monkeypatch):
    """The functions of the workers, run here with small chunks over several partitions."""
    rng = random.Random(1)
    sequences = sorted([tuple(rng.choice([1, 1, 2]) for _ in range(rng.randrange(6))), c] for c in range(60))
    rows = [
        {"seg": 0, "c1": 0, "c2": 0, "final": True, "conv_id": c, "more_leaves": 0, "more_saved": 0, "x1": [v * 7 + k for k, v in enumerate(s)],
         "x2": [v for v in s], "words": [v + 1 for v in s]} for s, c in sequences
    ]
    schema = pa.schema([(c, pa.int32() if c == "seg" else pa.bool_() if c == "final" else pa.list_(pa.int64()) if c in ("x1", "x2", "words") else pa.int64()) for c in rows[0]])

    class Part:
        now = 0

        def partitionId(self):
            return Part.now

    monkeypatch.setattr(prefix_trie.TaskContext, "get", staticmethod(lambda: Part()))
    want = None
    for cuts in ([60], [1, 2, 30, 60], list(range(1, 61)), [20, 40, 60]):
        found, begin = [], 0
        for k, end in enumerate(cuts):
            Part.now = k
            found += [r for b in prefix_trie._find_nodes(9, 6)(iter([pa.RecordBatch.from_pylist(rows[begin:end], schema)])) for r in b.to_pylist()]
            begin = end
        edges = sorted((r for r in found if r["kind"] == prefix_trie.EDGE), key=lambda r: (r["part"], r["last"]))
        columns = ["part", *prefix_trie._edge_names()]
        edges = pa.RecordBatch.from_pylist([{c: r[c] for c in columns} for r in edges])
        wrong = [r for b in prefix_trie._corrections(9)(iter([edges])) for r in b.to_pylist()]
        parts = [r for r in found if r["kind"] in (prefix_trie.OPEN, prefix_trie.VIRTUAL)] + wrong
        parts.sort(key=lambda r: (r["depth"], r["k1"], r["k2"], r["part"], r["chunk"]))
        merged = [r for b in prefix_trie._merge(iter([pa.RecordBatch.from_pylist(parts)])) for r in b.to_pylist()]
        names = ("depth", "k1", "k2", "p1", "p2", "least", "n", "n_ends", "children", "leaves", "saved", "ends")
        nodes = sorted(tuple(r[c] for c in names) for r in [*merged, *[r for r in found if r["kind"] == prefix_trie.CLOSED]])
        want = want or nodes
        assert nodes == want and len({n[:3] for n in nodes}) == len(nodes)
