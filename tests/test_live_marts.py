"""Marts kept by change feeds against their full rebuild."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vouchlake import schemas
from vouchlake.operators import mart_deltas, marts
from vouchlake.plans import checks
from vouchlake.plans.live_marts import LiveMarts
from vouchlake.session import prepare

AT = datetime(2026, 1, 1)
KEYS = {"orders_curated": "order_id", "customers_curated": "customer_id", "order_items_curated": "order_item_id", "returns_curated": "return_id"}


def order(rng, k):
    total = rng.choice([None, rng.randrange(100000) / 100])
    day = date(2024, 1, 1) + timedelta(days=rng.randrange(120))
    return (f"O{k}", rng.choice([None, "C1", "C1", "C2", "C3", "C9"]), day, "new", total, AT, "PASS", AT)


def item(rng, k):
    quantity, price = rng.choice([None, 0, 1, 2, 5]), rng.choice([None, 1.25, 19.99])
    return (f"I{k}", rng.choice([None, *[f"O{j}" for j in range(12)]]), rng.choice([None, "P1", "P1", "P2", "P3", "P4"]), "pen", quantity, price, AT)


def returned(rng, k):
    return (f"R{k}", rng.choice([None, *[f"O{j}" for j in range(12)]]), date(2024, 5, 1), "late", 1.0, AT)


def customer(rng, k):
    return (f"C{k}", "Ann", "a", "1", date(2020, 1, 1), "IN", AT)


MAKE = {"orders_curated": order, "customers_curated": customer, "order_items_curated": item, "returns_curated": returned}


def frame(spark, table, data):
    return spark.createDataFrame(data, schemas.CURATED[table])


def replacing(batch, key, columns):
    """Row images of a merge that takes batch rows as they are."""

    def images(held):
        both = held.alias("h").join(batch.alias("b"), F.col(f"h.{key}") == F.col(f"b.{key}"), "full_outer")
        old = F.when(F.col(f"h.{key}").isNotNull(), F.struct([F.col(f"h.{c}").alias(c) for c in columns]))
        new = F.when(F.col(f"b.{key}").isNotNull(), F.struct([F.col(f"b.{c}").alias(c) for c in columns]))
        return both.select(old.alias("before"), F.coalesce(new, old).alias("after"))

    return images


def same_as_rebuilt(store, live):
    t = {name: store.read(name) for name in KEYS}
    assert rows(live.customer_clv()) == rows(marts.customer_clv(t["customers_curated"], t["orders_curated"], 2))
    assert rows(live.monthly_sales()) == rows(marts.monthly_sales(t["orders_curated"], 2))
    assert rows(live.product_performance()) == rows(marts.product_performance(t["order_items_curated"], 2))
    assert rows(live.product_returns()) == rows(marts.product_returns(t["returns_curated"], t["order_items_curated"]))


def step(spark, store, rng, table, kind, n=6):
    key, data = KEYS[table], [MAKE[table](rng, k) for k in rng.sample(range(30), n)]
    batch = frame(spark, table, data)
    if kind == "delete":
        store.delete(table, key, batch)
    elif kind == "insert":  # also copies of keys that are there
        store.insert(table, key, batch)
    else:
        unique = batch.join(store.read(table).groupBy(key).count().where("count > 1"), key, "left_anti")
        store.merge(table, key, unique, replacing(unique, key, batch.columns))


def test_equal_to_the_full_rebuild_after_any_changes(spark, store):
    rng = random.Random(11)
    live = LiveMarts(store)
    for table in KEYS:
        store.insert(table, KEYS[table], frame(spark, table, [MAKE[table](rng, k) for k in range(1, 20)]))
    live.catch_up()
    same_as_rebuilt(store, live)
    for table, kinds in {
        "orders_curated": ["merge", "delete"],
        "customers_curated": ["insert"],
        "order_items_curated": ["insert", "merge"],
        "returns_curated": ["merge"],
    }.items():
        for kind in kinds:
            step(spark, store, rng, table, kind, 9)
    live.catch_up()
    same_as_rebuilt(store, live)
    # Everything goes, and so do the states.
    for table in ("orders_curated", "order_items_curated"):
        store.delete(table, KEYS[table], store.read(table))
    live.catch_up()
    same_as_rebuilt(store, live)
    assert live.state("monthly_state").count() == live.state("order_lines").where("order_id IS NOT NULL").count() == 0


def test_a_call_cut_short_is_taken_up_without_adding_twice(spark, store, monkeypatch):
    rng = random.Random(4)
    for table in ("returns_curated", "order_items_curated"):
        store.insert(table, KEYS[table], frame(spark, table, [MAKE[table](rng, k) for k in range(1, 20)]))
    live, calls = LiveMarts(store), []
    merge = type(store).merge
    for stop in (2, 4):

        def failing(self, *a, stop=stop, **k):
            calls.append(1)
            if len(calls) == stop:
                raise OSError("driver lost")
            return merge(self, *a, **k)

        with monkeypatch.context() as patch:
            patch.setattr(type(store), "merge", failing)
            with pytest.raises(OSError):
                live.catch_up()
    LiveMarts(store).catch_up()
    same_as_rebuilt(store, live)


def test_only_stale_customers_are_looked_at_again(spark):
    held = spark.createDataFrame(
        [("A", 2, 2, None, 0, date(2024, 1, 1), date(2024, 3, 1)), ("B", 3, 3, None, 0, date(2024, 1, 1), date(2024, 3, 1))],
        mart_deltas.STATES["customer_state"],
    )
    feed = [
        ("before", 2, "O1", "A", date(2024, 2, 1)), ("after", 2, "O1", "A", date(2023, 12, 1)),
        ("delete", 2, "O2", "B", date(2024, 3, 1)), ("insert", 2, "O3", "D", date(2024, 3, 1)),
    ]
    feed = spark.createDataFrame(feed, "image string, version long, order_id string, customer_id string, order_date date").withColumn("order_total", F.lit(1.0))
    delta = mart_deltas.customer_delta(feed)
    assert rows(mart_deltas.stale_customers(held, delta)) == [("B",)]
    ranges = spark.createDataFrame([("B", date(2024, 1, 1), date(2024, 2, 2))], "customer_id string, first_order_date date, last_order_date date")
    after = {r.after.customer_id: (r.after.n, r.after.first_order_date, r.after.last_order_date) for r in mart_deltas.customer_images(held, delta, ranges).collect()}
    assert after == {
        "A": (2, date(2023, 12, 1), date(2024, 3, 1)),
        "B": (2, date(2024, 1, 1), date(2024, 2, 2)),
        "D": (1, date(2024, 3, 1), date(2024, 3, 1)),
    }


def test_states_keep_rows_only_and_lines_that_cancel_change_nothing(spark, store):
    rng = random.Random(5)
    data = [item(rng, k) for k in range(20)]
    store.insert("order_items_curated", "order_item_id", frame(spark, "order_items_curated", data))
    live = LiveMarts(store)
    live.catch_up()
    batch = frame(spark, "order_items_curated", [(*row[:4], 7, *row[5:]) for row in data])
    store.merge("order_items_curated", "order_item_id", batch, replacing(batch, "order_item_id", batch.columns))
    assert mart_deltas.lines_delta(store.changes("order_items_curated", 1)).count() == 0
    live.catch_up()
    assert rows(live.product_performance()) == rows(marts.product_performance(store.read("order_items_curated"), 2))
    for table in ("mart_product_state", "mart_order_lines"):
        kinds = {path.rsplit("/", 2)[-2] for path in store.read(table).inputFiles()}
        assert kinds == {"image=row"}
        with pytest.raises(ValueError, match="no change feed"):
            store.changes(table, store.version(table) - 1)
        folders = {name for folder in os.listdir(f"{store.root}/{table}") if os.path.isdir(f"{store.root}/{table}/{folder}/files") for name in os.listdir(f"{store.root}/{table}/{folder}/files")}
        assert {name for name in folders if name.startswith("image=")} == {"image=row"}


def shuffle_files(spark):
    names = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {name for name in names.split("\n") if "/shuffle_" in name}


def test_changes_leave_no_shuffles(spark, store):
    rng = random.Random(6)
    store.insert("order_items_curated", "order_item_id", frame(spark, "order_items_curated", [item(rng, k) for k in range(20)]))
    live = LiveMarts(store)
    live.catch_up()
    batch = frame(spark, "order_items_curated", [item(rng, k) for k in range(10, 30)])
    before = shuffle_files(spark)
    store.merge("order_items_curated", "order_item_id", batch, replacing(batch, "order_item_id", batch.columns))
    store.delete("order_items_curated", "order_item_id", batch.limit(5))
    store.replace("items_by_product", store.read("order_items_curated").groupBy("product_id").count())
    assert shuffle_files(spark) <= before
    live.catch_up()
    assert shuffle_files(spark) <= before


def test_the_check_gives_back_what_the_marts_have_applied(spark):
    live = checks.Stage(prepare(spark), "/root/testdata/sf0.001").live("order_items_curated")
    store = live.store
    assert rows(live.product_performance()) == rows(marts.product_performance(store.read("order_items_curated"), 2))
    assert not store.exists("order_items_curated_rows") and [n for n, _, _ in store._versions("order_items_curated")] == [3]
    held = [name for folder, _, names in os.walk(f"{store.root}/order_items_curated") for name in names if name.endswith(".parquet") and "/v00000003/" not in folder]
    assert len(held) == sum("/v00000003/" not in path for path in store.read("order_items_curated").inputFiles())
