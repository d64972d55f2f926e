"""The registered queries of the training-data operators against DuckDB, and those without SQL by their shape."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA
from vouchlake.llm import oracle, queries

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(oracle.statements()) <= set(queries.QUERIES) and set(oracle.statements()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    expected = duck.sql(oracle.statements()[name])
    order = sorted(df.columns)
    assert sorted(expected.columns) == order

    def bag(columns, data):
        places = [columns.index(c) for c in order]
        return sorted(repr(tuple(row[i] for i in places)) for row in data)

    got = bag(df.columns, [tuple(r) for r in df.collect()])
    assert got and got == bag(expected.columns, expected.fetchall())


COLUMNS = {
    "op2_nearest": ["query_id", "rank", "vec_id", "score"],
    "op6_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_class_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9_pieces": ["doc_id", "ids", "n_ids", "round_trip"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name]) <= set(df.columns)
    rows = df.collect()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert len(rows) == (50 if name == "op2_nearest" else documents)
    if name == "op7_class_lm":
        held = [r for r in rows if r.held_out]
        assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
