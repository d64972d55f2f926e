"""What the joins leave on the disk, and what their plans say."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from vouchlake.llm import common, ngram_join
from vouchlake.llm.line_dedup import Rarity


def test_the_ngram_join_keeps_its_wide_records_once_and_leaves_nothing(spark, tmp_path, monkeypatch):
    made = []

    def scratch(_, label):
        # What is there when the next step is written.
        made.append((label, {x.rsplit("-", 1)[0] for x in os.listdir(tmp_path)}))
        return f"{tmp_path}/{label}-{len(made)}"

    monkeypatch.setattr(common, "scratch_dir", scratch)
    words = "it was a bright cold day in april and the clocks were striking thirteen".split()
    texts = [" ".join(words), " ".join([*words, "again"]), " ".join(words[::-1]), None, " ".join(words)]
    docs = spark.createDataFrame([(k, text) for k, text in enumerate(texts)], "doc_id long, text string")
    kept = ngram_join.first_of_each(docs, 2, 8, 10)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    assert all("ngram-records" not in held for label, held in made if label in ("ngram-crowded", "ngram-tiles", "edges"))
    assert {x.rsplit("-", 1)[0] for x in os.listdir(tmp_path)} == {"ngram-later"}


def test_documents_of_one_id_and_length_are_told_apart_in_tiles(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(5, a), (5, b), (7, b), (3, a)], "doc_id long, text string")
    found = ngram_join.ngram_components(docs, 2, 8, 10).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (5, 3), (5, 3), (7, 3)]


def test_a_plan_names_the_classes_of_words_briefly(spark):
    order = Rarity([126, 3] * 2048)
    hashes = [-1, 0, 1, 2**63 - 1, -(2**63), 123456789123]
    found = spark.createDataFrame([(hashes,)], "w array<long>").select(order.keys(F.col("w")).alias("k"))
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 6 * 4096
    assert found.first().k == sorted((order.classes[w & 4095] << 56) | ((w % 2**64) >> 8) for w in hashes)
