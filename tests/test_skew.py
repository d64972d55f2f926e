"""Plans under a key that holds a third of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF
from vouchlake import schemas
from vouchlake.operators import curation, governance, marts
from vouchlake.operators.upsert import merge_into_raw

FORCED = {
    # No broadcast, many small partitions: the shape of a large job.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "24",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
}
APART = "spark.sql.adaptive.coalescePartitions.enabled"


@pytest.fixture
def large_job(spark):
    old = {name: spark.conf.get(name, None) for name in FORCED}
    for name, value in FORCED.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in old.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def hot(spark, key="order_id", hot_value="O7", n=60000, prefix="O"):
    """A third of the rows share one key (NULL when ``hot_value`` is None)."""
    i = F.col("id")
    value = F.lit(hot_value) if hot_value else F.lit(None).cast("string")
    return spark.range(0, n, 1, 8).select(
        F.when(i % 3 == 0, value).otherwise(F.concat(F.lit(prefix), i)).alias(key), F.sha2(i.cast("string"), 512).alias("pad"), i.alias("id")
    )


def final_plan(df):
    """Run the very plan and return its text after adaptive re-planning."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("Initial Plan")[0]


def raw_orders(spark, hot_value="O7"):
    h = hot(spark, hot_value=hot_value)
    return h.select(
        "order_id", F.lit("C1").alias("customer_id"), F.lit("2024-01-01").alias("order_date"), F.col("pad").alias("order_status"),
        F.lit("1.00").alias("order_total"), F.lit("2024-01-01 00:00:00").alias("source_updated_at"), F.lit("PASS").alias("row_status"),
        F.lit(AS_OF.isoformat(" ")).cast("timestamp").alias("ingestion_time"), F.lit("f").alias("source_file"),
    )


def keys(spark, n=60000):
    return spark.range(0, n, 1, 8).select(F.concat(F.lit("O"), F.col("id")).alias("order_id"))


def splits(plan):
    return len(re.findall(r"SortMergeJoin\(skew=true\)", plan))


@pytest.mark.parametrize("hot_value", ["O7", None])
def test_governance_splits_a_hot_order(large_job, hot_value):
    plan = final_plan(governance.governance_status(raw_orders(large_job, hot_value), keys(large_job)))
    assert splits(plan) == 1


def test_cascade_splits_a_hot_order(large_job):
    items = hot(large_job).select(
        F.col("id").cast("string").alias("order_item_id"), "order_id", F.lit("P1").alias("product_id"), F.col("pad").alias("product_name"),
        F.lit("1").alias("quantity"), F.lit("1.0").alias("unit_price"), F.current_timestamp().alias("ingestion_time"),
    )
    gate = raw_orders(large_job)
    assert splits(final_plan(curation.curate_order_items(items, gate))) == 1


def test_missing_invoice_splits_null_orders(large_job):
    failed = raw_orders(large_job, None).withColumn("row_status", F.lit(schemas.FAIL))
    log = keys(large_job, 1000).select(
        F.col("order_id").alias("record_id"), F.lit("orders_raw").alias("source_table"), F.lit(schemas.MISSING_INVOICE).alias("error_message"),
        F.lit(False).alias("resolved_flag"),
    )
    assert splits(final_plan(curation.errors_missing_invoice(failed, log, AS_OF))) == 1


def read_by_task(df):
    """Rows each task of the final stage gives out."""
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_upsert_spreads_rows_without_key(large_job):
    """NULL keys that pile up in the table do not meet in one task."""
    target = raw_orders(large_job, None)
    stage = target.filter("order_id is not null").select(schemas.STAGE["orders"].fieldNames())
    merged = merge_into_raw("orders", target, stage, AS_OF)
    large_job.conf.set(APART, "false")
    sizes = read_by_task(merged)
    large_job.conf.unset(APART)
    assert sum(sizes) == 60000 and max(sizes) < 60000 / 3


def test_upsert_takes_copies_of_a_new_key(large_job):
    orders = raw_orders(large_job, "N1")
    stage = orders.select(schemas.STAGE["orders"].fieldNames())
    assert merge_into_raw("orders", orders.filter("order_id <> 'N1'"), stage, AS_OF).count() == 60000


def test_returns_meet_the_items_of_a_hot_order(large_job):
    lines = hot(large_job).select("order_id", F.col("pad").alias("product_id"))
    back = hot(large_job, n=30000).select("order_id", F.col("pad").alias("return_id"))
    met = marts.returns_of_items(lines, back)
    assert splits(final_plan(met)) == 1


def test_product_returns_splits_a_hot_order(large_job):
    items = hot(large_job).select("order_id", F.col("pad").alias("product_id"), F.lit(1).cast("long").alias("quantity"))
    back = hot(large_job, n=30000).select("order_id", F.col("pad").alias("return_id"))
    got = marts.product_returns(back, items)
    assert splits(final_plan(got)) == 1
    assert got.agg(F.sum("total_returned")).first()[0] == 20001 * 10001 + 19999


def test_folding_before_the_shuffle(large_job):
    """A hot customer leaves one row per map task."""
    orders = hot(large_job, "customer_id", "C7", prefix="C").select(
        F.col("id").cast("string").alias("order_id"), "customer_id", F.lit(1.0).alias("order_total"), F.lit("2024-01-01").cast("date").alias("order_date")
    )
    customers = hot(large_job, "customer_id", "C7", prefix="C").select("customer_id")
    plan = final_plan(marts.customer_clv(customers, orders))
    # Both sides are grouped before they meet, in two shuffles all in all.
    assert plan.count("partial_count") >= 2
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) == 2


def test_distinct_orders_spread_a_hot_product(large_job):
    items = hot(large_job, "product_id", "P7", prefix="P").select(
        "product_id", F.col("id").cast("string").alias("order_id"), F.lit(1).cast("long").alias("quantity"), F.lit(1.0).alias("unit_price")
    )
    plan = final_plan(marts.product_performance(items))
    first = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)[-1]
    assert "product_id" in first and "order_id" in first
