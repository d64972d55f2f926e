"""Distinct counts merged from bitmaps against the count over all rows."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from vouchlake import schemas
from vouchlake.operators import distinct_maps, marts

AT = datetime(2025, 1, 1)


def items(spark, rng, n, start=0):
    data = []
    for k in range(n):
        order, product = rng.choice([None, *[f"O{j}" for j in range(40)]]), rng.choice([None, "P1", "P1", "P1", "P2", "P3", "P4"])
        data.append((f"I{start + k}", order, product, "pen", rng.choice([None, 1, 2]), rng.choice([None, 1.25, 3.5]), AT))
    return spark.createDataFrame(data, schemas.CURATED["order_items_curated"])


def test_slices_that_share_orders_merge_exactly(spark, store):
    rng, seen = random.Random(3), None
    for k in range(3):
        part = items(spark, rng, 90, 1000 * k).repartition(3)
        seen = part if seen is None else seen.unionByName(part)
        for _ in range(2):  # a repeated slice adds nothing
            distinct_maps.add_items(store, part, f"slice-{k}")
        got = distinct_maps.product_performance(store.read(distinct_maps.SUMS), store.read(distinct_maps.MAPS))
        assert rows(got) == rows(marts.product_performance(seen, 2))
    numbers = sorted(r.number for r in store.read(distinct_maps.NUMBERS).collect())
    assert numbers == list(range(1, 41))  # dense, and given once


def test_a_number_at_the_edge_of_a_range(spark):
    numbers = spark.createDataFrame([(f"O{n}", n) for n in (1, 32767, 32768, 32769, 65536, 65537)], "order_id string, number long")
    sold = spark.createDataFrame([("I", f"O{n}", "P", "pen", 1, 1.0, AT) for n in (1, 32767, 32768, 32769, 65536, 65537, 65537)], schemas.CURATED["order_items_curated"])
    maps = distinct_maps.maps_of(sold, numbers)
    got = distinct_maps.product_performance(distinct_maps.sums_of(sold), maps.unionByName(maps))
    assert [(r.product_id, r.total_orders) for r in got.collect()] == [("P", 6)] and maps.count() >= 2


def test_the_mart_reads_no_item_and_no_number(spark, store):
    distinct_maps.add_items(store, items(spark, random.Random(1), 30), "one")
    sums, maps = store.read(distinct_maps.SUMS), store.read(distinct_maps.MAPS)
    files = {f.split("/")[-4] for f in distinct_maps.product_performance(sums, maps).inputFiles()}
    assert files == {distinct_maps.SUMS, distinct_maps.MAPS}
    assert distinct_maps.product_performance(sums.limit(0), maps.limit(0)).count() == 0


def test_scattered_orders_take_few_bytes(spark):
    numbers = spark.range(0, 200 * 32768, 32768).select(F.concat(F.lit("O"), "id").alias("order_id"), F.col("id").alias("number"))
    sold = numbers.select(F.lit("I").alias("order_item_id"), "order_id", F.lit("P").alias("product_id"))
    maps = distinct_maps.maps_of(sold, numbers)
    assert maps.count() == 200 and dict(maps.dtypes)["map"] == "bigint"
    full = spark.range(1, 1001).select(F.concat(F.lit("O"), "id").alias("order_id"), F.col("id").alias("number"))
    hot = full.select("order_id", F.lit("P").alias("product_id"))
    maps = distinct_maps.maps_of(hot.unionByName(hot), full)
    assert maps.count() == 16 and maps.agg(F.sum(F.bit_count("map"))).first()[0] == 1000
