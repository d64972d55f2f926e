"""The stages in a row, each compared with a plain version on the rows it was given."""

from __future__ import annotations

import collections

import corpus_pipeline
import sentencepiece

from tests.llm.test_operators import EDGES, SCHEMA, plain_components, plain_removed
from vouchlake.llm import mixing, pieces

SF_DIR = "/root/testdata/sf0.001"


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "identify_language", "dedup_lines", "join_ngrams", "mix_sources", "encode_pieces"
    ]


def test_each_stage_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, given = docs.columns, {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if name != "encode_pieces":
            assert docs.columns == columns
        if name == "identify_language":
            assert len(rows) >= 0.98 * len(given) and all(r == given[r.doc_id] for r in rows)
        if name == "dedup_lines":
            gone = plain_removed(sorted((d, r.text) for d, r in given.items()))
            want = {}
            for doc_id, row in given.items():
                left = [x for n, x in enumerate(row.text.split("\n")) if n not in gone[doc_id]]
                if left:
                    want[doc_id] = "\n".join(left)
            assert {r.doc_id: r.text for r in rows} == want
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "join_ngrams":
            found = plain_components([(d, r.text) for d, r in given.items()], 5, 8, 10)
            assert {r.doc_id for r in rows} == {d for d, (_, c) in found.items() if d == c}
        if name == "mix_sources":
            copies = collections.Counter(r.doc_id for r in rows)
            plan = mixing.mix_plan(spark.createDataFrame(list(given.values()), docs.schema)).collect()
            for r in plan:
                last = int(r.rest > 0 and 2 * r.start + r.size <= 2 * r.rest)
                assert copies[r.doc_id] == r.epochs + last
        if name == "encode_pieces":
            library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
            assert all(r.round_trip and r.ids == library.encode(given[r.doc_id].text) for r in rows)
        else:
            given = {r.doc_id: r for r in rows}


def test_stages_take_odd_rows_and_empty_tables(spark, tmp_path):
    for k, data in enumerate(([(*row, "s", "m", 1, 2, 3, 4) for row in EDGES], [])):
        docs = spark.createDataFrame(data, SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{k}-{name}")
            stage(spark, docs, SF_DIR).write.parquet(path)
            columns, docs = docs.columns, spark.read.parquet(path)
            assert name == "encode_pieces" or docs.columns == columns
        assert docs.count() == 0 if not data else docs.count() > 0
