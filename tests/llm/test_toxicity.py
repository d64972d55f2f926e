"""Toxic passages: segments and evidence against plain versions, held-out labels, and what a table can hold."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vouchlake.llm import queries, toxicity

SCHEMA = "doc_id long, text string, score string, Evidence int, passages int, toxic int"


def plain_segments(scores):
    """All maximal scoring segments by their recursive definition: the best one, then left and right of it."""
    found = []

    def search(low, high):
        best = None
        for a in range(low, high):
            total = 0
            for b in range(a + 1, high + 1):
                total += scores[b - 1]
                if total > 0 and (best is None or total > best[0]):
                    best = (total, a, b)
        if best:
            search(low, best[1])
            found.append(best)
            search(best[2], high)

    search(0, len(scores))
    return found


def test_segments_are_the_maximal_ones():
    rng = random.Random(5)
    for n in (0, 1, 2, 7, 25, 25, 25, 60):
        for _ in range(20):
            # Powers of a small number make sums exact and ties rare.
            scores = [rng.choice([-1, 1]) * rng.randrange(1, 1 << 20) / 1024 for _ in range(n)]
            assert toxicity.maximal_segments(np.array(scores)) == plain_segments(scores)
    assert toxicity.maximal_segments(np.array([-1.0, -2.0])) == []
    assert len(toxicity.maximal_segments(np.tile([1.0, -2.0], 100_000))) == 100_000


def test_evidence_is_the_least_tail_of_sums():
    some, n, rate, size = [3.0, 9.0, 7.5, 0.5], 200, 1.1, -1.0
    normal = sorted((rate * s - size - math.log(n) for s in some), reverse=True)
    tails = []
    for r in range(1, len(normal) + 1):
        if normal[r - 1] <= 0:
            break
        total = sum(normal[:r])
        tails.append(math.exp(-total) * total ** (r - 1) / math.factorial(r) / math.factorial(r - 1))
    assert toxicity.evidence(some, n, rate, size) == pytest.approx(max(0.0, -math.log(min(tails))))
    assert toxicity.evidence([], 1, rate, size) == 0.0


def test_tokens_of_texts():
    texts = ["Ein Wort, zwei\nWörter ein", None, "", "𝄞 ☃ x1y", "no"]
    found = list(toxicity._texts(pa.array(texts)))
    assert len(found) == len(texts)
    for text, tokens in zip(texts, found, strict=True):
        spans = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z\u0080-\U0010ffff]+", text or "")]
        assert list(zip(tokens.start.tolist(), tokens.end.tolist(), strict=True)) == spans
    assert found[0].turn.tolist() == [1, 1, 1, 1, 2] and found[0].word[0] == found[0].word[4]


def texts(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = [rng.choice("abcdefgh") * rng.randrange(1, 9) + rng.choice("xyz") for _ in range(rng.randrange(5, 80))]
        toxic = int(rng.random() < 0.2)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["badword", "badly", "awful", "Nasty,"]))
        rows.append((k, " ".join(words), "s", 1, 2, toxic))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = spark.createDataFrame(texts(600, 1), SCHEMA)
    return toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))


def test_unseen_texts_are_told_apart_and_passages_located(spark, learned):
    rows = spark.createDataFrame(texts(200, 2), SCHEMA)
    found = toxicity.score_documents(rows, learned)
    assert found.columns == ["doc_id", "score", "Evidence", "passages", "toxic", "_score", "_evidence", "_passages"]
    text = {r.doc_id: r.text for r in rows.collect()}
    wrong = 0
    for row in found.collect():
        assert 0 <= row["_score"] <= 1
        wrong += (row["_score"] >= 0.5) != bool(row.toxic)
        for p in row["_passages"]:
            assert re.search("(?i)bad|awful|nasty", text[row.doc_id][p.start : p.end]) or not row.toxic
    assert wrong <= 4
    again = toxicity.score_documents(rows.repartition(3), learned).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found.collect()))


def test_odd_texts_and_no_rows(spark, learned):
    rows = [(1, None, "s", 1, 2, 3), (None, "", "s", 1, 2, 3), (2, "12 !? 3", "s", 1, 2, 3), (4, "b " * 300_000 + "badword awful nasty badly", "s", 1, 2, 3), (4, "badword awful nasty badly", "s", 1, 2, 3)]
    found = {(r.doc_id, r["_evidence"] > 0): r for r in toxicity.score_documents(spark.createDataFrame(rows, SCHEMA), learned).collect()}
    assert found[1, False]["_score"] == found[None, False]["_score"] == found[2, False]["_score"] < 0.5
    assert found[4, True]["_score"] >= 0.5 and found[4, True]["_passages"]
    assert toxicity.score_documents(spark.createDataFrame([], SCHEMA), learned).count() == 0


@pytest.mark.parametrize("label, want", [(None, 0.0), (1, 3.5 / 4), (0, 0.5 / 4)])
def test_without_both_classes(spark, label, want):
    rows = spark.createDataFrame([(k, "some text", "s", 1, 2, label) for k in range(3)], SCHEMA)
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert [r.score for r in toxicity.score_documents(rows.select("doc_id", "text"), model).collect()] == pytest.approx([want] * 3)


def test_the_sample_is_bounded_and_takes_both_classes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_ROWS", 100)
    labels = [(k, int(k % 10 == 0)) for k in range(3000)] + [(5, 1), (None, 1), (7, None), (8, 2)]
    found = toxicity._sample(spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    for toxic in (0, 1):
        some = {r.labelled_id for r in found if r.toxic == toxic}
        assert 50 <= len(some) <= 100 and all((k % 10 == 0 or k == 5) == bool(toxic) for k in some)


def test_held_out_labels_of_the_given_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op12_toxicity(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    told = found.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    assert {r.toxic: r.p >= 0.5 for r in told} == {0: False, 1: True}
    assert all((r.p > 0.9 if r.toxic else r.p < 0.01) for r in told)
