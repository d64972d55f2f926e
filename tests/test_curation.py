from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, rows
from tests.test_documents import orders
from vouchlake import schemas
from vouchlake.operators import curation

DATES = ["01-02-2024", "2024-02-01", "2024/02/01", "", None, "01-02-2024\n"]


def customers(spark, texts):
    data = [(f"C{i}", "n", "e", "p", t, "x", AS_OF, "f") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, schemas.RAW["customers_raw"])


def test_customers_split_into_curated_and_logged(spark):
    raw = customers(spark, DATES)
    good = curation.curate_customers(raw)
    assert rows(good.select("customer_id", "created_date")) == [("C0", date(2024, 2, 1)), ("C1", date(2024, 2, 1))]
    assert good.schema.fieldNames() == schemas.CURATED["customers_curated"].fieldNames()
    logged = curation.errors_customer_dates(raw, AS_OF)
    assert rows(logged.select("record_id")) == [("C2",), ("C3",), ("C5",)]
    assert logged.schema.fieldNames() == schemas.CURATED["data_error_logs"].fieldNames()
    # NULL dates drop out silently unless asked for.
    asked = curation.errors_customer_dates(raw, AS_OF, missing=True)
    assert rows(asked.select("record_id", "error_message"))[-1] == ("C5", "Invalid created_date format")
    assert ("C4", "Missing created_date") in rows(asked.select("record_id", "error_message"))


def test_impossible_dates_fail_or_go_to_the_log(spark):
    raw = customers(spark, ["2024-02-01", "31-02-2024"])
    with pytest.raises(Exception, match="impossible date: 31-02-2024"):
        curation.curate_customers(raw).collect()
    assert curation.curate_customers(raw, "quarantine").count() == 1
    logged = curation.errors_customer_dates(raw, AS_OF, impossible=True)
    assert rows(logged.select("record_id", "error_message")) == [("C1", "Impossible created_date")]
    assert curation.errors_customer_dates(raw, AS_OF).count() == 0


def test_orders_that_do_not_pass_are_not_parsed(spark):
    raw = orders(spark, [("O1", "PASS"), ("O2", "FAIL"), ("O3", None)]).withColumn(
        "order_date", F.when(F.col("order_id") == "O1", F.col("order_date")).otherwise("31-02-2024")
    )
    assert rows(curation.curate_orders(raw).select("order_id", "order_total")) == [("O1", 1.0)]
    assert curation.errors_order_dates(raw.withColumn("order_date", F.lit("x")), AS_OF).count() == 1


def test_children_cascade(spark):
    gate = curation.curate_orders(orders(spark, [("O1", "PASS"), ("O1", "PASS"), ("O2", "FAIL")]))
    items = spark.createDataFrame(
        [(f"I{k}", k, "P1", "n", "3", "1.50", AS_OF, "f") for k in ("O1", "O2", None)], schemas.RAW["order_items_raw"]
    )
    assert rows(curation.curate_order_items(items, gate)) == [("IO1", "O1", "P1", "n", 3, 1.5, AS_OF)]
    payments = spark.createDataFrame(
        [(f"P{k}{i}", k, t, "card", "2.5", "ok", AS_OF, "f") for k in ("O1", "O2") for i, t in enumerate(DATES)],
        schemas.RAW["payments_raw"],
    )
    assert rows(curation.curate_payments(payments, gate).select("payment_id")) == [("PO10",), ("PO11",)]
    # The log covers every payment, whether its order passed or not.
    assert curation.errors_payment_dates(payments, AS_OF).count() == 6
    with pytest.raises(Exception):
        curation.curate_order_items(items.withColumn("quantity", F.lit("3.0")), gate).collect()


def test_only_new_errors(spark):
    raw = customers(spark, ["x", "y"])
    first = curation.errors_customer_dates(raw.limit(1), AS_OF)
    both = curation.errors_customer_dates(raw, AS_OF)
    assert rows(curation.only_new_errors(both, first).select("record_id")) == [("C1",)]
    closed = first.withColumn("resolved_flag", F.lit(True))
    assert curation.only_new_errors(both, closed).count() == 2
