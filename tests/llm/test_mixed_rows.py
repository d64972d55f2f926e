"""Words whose bytes follow a pattern, vectors of several sizes, labelled rows without text."""

from __future__ import annotations

import numpy as np
import sentencepiece

from vouchlake.llm import brown, language_id, multi_index, near_vectors, ngram_join, pieces, words

# Two words that every polynomial hash modulo a power of two takes for one.
PATTERN = [bin(k).count("1") % 2 for k in range(1024)]
ONE, OTHER = ("".join(pair[bit] for bit in PATTERN) for pair in ("ab", "ba"))


def test_word_hashes_tell_patterned_words_apart():
    data = np.frombuffer(f"{ONE} {OTHER} {ONE}".encode(), dtype=np.uint8)
    start, end, _ = words.word_spans(data, np.array([0, len(data)]))
    first, second, third = words.word_hashes(data, start, end)
    assert first == third != second
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 400_000).astype(np.uint8)
    data[rng.random(len(data)) < 0.05] = 32
    start, end, _ = words.word_spans(data, np.array([0, len(data)]))
    text = data.tobytes()
    assert len(np.unique(words.word_hashes(data, start, end))) == len({text[a:b] for a, b in zip(start, end, strict=True)})


def test_join_does_not_link_them(spark):
    docs = spark.createDataFrame([(1, ONE), (2, OTHER), (3, ONE)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs, 3, 9, 10).collect()} == {1: 1, 2: 2, 3: 1}


def test_pieces_decode_to_them(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"{ONE} {OTHER}")], "doc_id long, text string")
    row = pieces.encode(docs).first()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert row.round_trip and row.ids == library.encode(f"{ONE} {OTHER}")


def test_units_of_one_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "word_hashes", lambda data, start, end: (end - start).astype(np.uint64) % np.uint64(2))
    data = np.frombuffer(b"abc abd abc ab xyz abc", dtype=np.uint8)
    start, end, _ = words.word_spans(data, np.array([0, len(data)]))
    at, same = pieces._distinct(data, start, end)
    text = data.tobytes()
    assert [text[start[k] : end[k]] for k in at[same]] == text.split()


def test_class_model_does_not_know_the_other(spark):
    train = spark.createDataFrame([(1, ONE)], "doc_id long, text string")
    model, counts = brown.fit(train)
    found = brown.score(spark.createDataFrame([(1, ONE), (2, OTHER)], "doc_id long, text string"), model, counts).collect()
    assert {r.doc_id: r.n_known for r in found} == {1: 2, 2: 1}


def test_queries_of_every_size_are_answered(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(16).tolist()) for k in range(200)] + [(1000 + k, [1.0, float(k), 2.0]) for k in range(4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = multi_index.search(table, table.where("vec_id IN (0, 1000)")).collect()
    near = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 1000)}
    assert len(near[0]) == 5 and all(v < 200 for v in near[0]) and near[1000] == [1001, 1002, 1003]


def test_vectors_of_every_size_are_linked(spark):
    rng = np.random.default_rng(4)
    rows = [(k, "x", rng.standard_normal(16).tolist()) for k in range(50)]
    rows += [(100 + k, "x", [1.0, 2.0, 3.0]) for k in range(4)] + [(200, "x", [1.0] * 16), (201, "x", [2.0] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    found = {r.vec_id: r for r in near_vectors.vector_components(table).collect()}
    assert len(found) == len(rows)
    assert [(found[k].n_links, found[k].component_id, found[k].kept) for k in range(100, 104)] == [(3, 100, k == 100) for k in range(100, 104)]
    assert (found[201].n_links, found[201].component_id) == (1, 200)
    assert near_vectors.audit(table, spark.createDataFrame(list(found.values())), near_vectors.F.lit(True)) == (14, 14)


def test_sample_places_go_to_texts_with_letters(spark):
    rows = [(k, None if k % 2 else "12 34", "xx") for k in range(300)] + [(1000 + k, f"wort {k} und noch eins", "xx") for k in range(5)]
    rows += [(7, "the one id that holds very many rows of text", "yy")] * 500 + [(8, "another text of that language", "yy")]
    found = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert found["xx"].count(b"wort") == 5
    assert found["yy"].count(b"very many") == 1 and b"another" in found["yy"]
