import random
from datetime import datetime

import pytest

from tests.conftest import AS_OF, rows
from vouchlake import schemas
from vouchlake.operators.upsert import merge_into_raw

OLD = datetime(2025, 1, 1)


@pytest.fixture(autouse=True, params=["-1", "10MB"])
def threshold(request, spark):
    """Both ways of merging: with a shuffle of the table, and with a broadcast batch."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def raw_orders(spark, data):
    return spark.createDataFrame(data, schemas.RAW["orders_raw"])


def stage_orders(spark, data):
    return spark.createDataFrame(data, schemas.STAGE["orders"])


def stored(key, at, status="PASS", total="1.00"):
    return (key, "C1", "2024-01-01", "new", total, at, status, OLD, "orders.csv")


def batch(key, at, total="2.00"):
    return (key, "C2", "2024-01-02", "changed", total, at)


def test_newer_wins_and_status_stays(spark):
    target = raw_orders(
        spark,
        [
            stored("O1", "2024-01-01 00:00:00"),
            stored("O2", "2024-01-02 00:00:00"),
            stored("O3", "2024-01-03 00:00:00"),
            stored("O4", None),
            stored("O5", "2024-01-01 00:00:00"),
            stored(None, "2024-01-01 00:00:00"),
        ],
    )
    source = stage_orders(
        spark,
        [
            batch("O1", "2024-01-02 00:00:00"),
            batch("O2", "2024-01-02 00:00:00"),
            batch("O3", "2024-01-02 00:00:00"),
            batch("O4", "2024-01-02 00:00:00"),
            batch("O5", None),
            batch("O9", "2024-01-02 00:00:00"),
            batch("O8", "2024-01-02 00:00:00", "3.00"),
            batch("O8", "2024-01-02 00:00:00", "4.00"),
            batch(None, "2024-01-02 00:00:00"),
        ],
    )
    got = merge_into_raw("orders", target, source, AS_OF).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r.order_id, []).append(r)
    assert len(got) == 6 + 4
    first = by_key["O1"][0]
    assert (first.order_status, first.row_status, first.ingestion_time) == ("changed", "PASS", AS_OF)
    for key in ("O2", "O3", "O4", "O5"):
        assert [(r.order_status, r.ingestion_time) for r in by_key[key]] == [("new", OLD)]
    assert [(r.row_status, r.source_file) for r in by_key["O9"]] == [("FAIL", "orders.csv")]
    assert sorted(r.order_total for r in by_key["O8"]) == ["3.00", "4.00"]
    assert sorted(r.order_status for r in by_key[None]) == ["changed", "new"]


def test_repeated_key_on_a_match_fails(spark):
    target = raw_orders(spark, [stored("O1", "2024-01-05 00:00:00")])
    # Older rows would change nothing, the repetition is an error all the same.
    source = stage_orders(spark, [batch("O1", "2024-01-01 00:00:00"), batch("O1", "2024-01-02 00:00:00")])
    merged = merge_into_raw("orders", target, source, AS_OF)
    with pytest.raises(Exception, match="more than one batch row for stored key O1"):
        merged.collect()
    with pytest.raises(Exception, match="more than one batch row for stored key O1"):
        merged.select("order_status").collect()


def test_bad_timestamp_fails_only_on_a_match(spark):
    target = raw_orders(spark, [stored("O1", "2024-01-05 00:00:00")])
    assert merge_into_raw("orders", target, stage_orders(spark, [batch("O2", "soon")]), AS_OF).count() == 2
    with pytest.raises(Exception):
        merge_into_raw("orders", target, stage_orders(spark, [batch("O1", "soon")]), AS_OF).collect()


def test_items_keep_order_and_product(spark):
    target = spark.createDataFrame([("I1", "O1", "P1", "old", "1", "1.0", OLD, "x")], schemas.RAW["order_items_raw"])
    source = spark.createDataFrame([("I1", "O2", "P2", "fresh", "5", "9.0")], schemas.STAGE["order_items"])
    assert rows(merge_into_raw("order_items", target, source, AS_OF)) == [
        ("I1", "O1", "P1", "fresh", "5", "9.0", AS_OF, "order_items.csv")
    ]


def test_same_batch_twice_changes_only_the_stamp(spark):
    target = schemas.empty(spark, "payments_raw")
    source = spark.createDataFrame(
        [(f"PAY{i}", "O1", "2024-01-01", "card", "1.00", "settled") for i in range(20)], schemas.STAGE["payments"]
    )
    once = merge_into_raw("payments", target, source, OLD)
    twice = merge_into_raw("payments", once, source, AS_OF)
    assert rows(once.drop("ingestion_time")) == rows(twice.drop("ingestion_time"))
    assert {r[0] for r in twice.select("ingestion_time").collect()} == {AS_OF}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    """Random tables with NULL keys and repeated new keys."""
    rnd = random.Random(seed)
    held = [rnd.choice(["C%d" % i for i in range(12)] + [None]) for _ in range(25)]
    incoming = ["C%d" % i for i in rnd.sample(range(12), 6)]
    incoming += [rnd.choice(["N1", "N2", None]) for _ in range(8)]
    target = [(k, f"t{i}", "e", "p", "d", "c", OLD, "f") for i, k in enumerate(held)]
    source = [(k, f"s{i}", "e2", "p2", "d2", "c2") for i, k in enumerate(incoming)]

    stamp = (AS_OF, "customers.csv")
    known = {k for k in held if k is not None}
    unique = {r[0]: r for r in source if r[0] in known}
    expected = [(unique[r[0]] + stamp) if r[0] in unique else r for r in target]
    expected += [r + stamp for r in source if r[0] not in unique]

    got = merge_into_raw(
        "customers",
        spark.createDataFrame(target, schemas.RAW["customers_raw"]),
        spark.createDataFrame(source, schemas.STAGE["customers"]),
        AS_OF,
    )
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("table", ["orders", "order_items"])
def test_one_shuffle_of_each_input(spark, threshold, tmp_path, table):
    """Counted in the plan that ran; nothing runs before."""
    raw, stage = schemas.RAW[f"{table}_raw"], schemas.STAGE[table]
    spark.createDataFrame([], raw).write.parquet(str(tmp_path / "raw"))
    spark.createDataFrame([], stage).write.parquet(str(tmp_path / "stage"))
    target, source = spark.read.schema(raw).parquet(str(tmp_path / "raw")), spark.read.schema(stage).parquet(str(tmp_path / "stage"))
    merged = merge_into_raw(table, target, source, AS_OF)
    if threshold == "-1":
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert (plan.count("Exchange hashpartitioning"), plan.count("FileScan parquet"), plan.count("Join")) == (2, 2, 1)
