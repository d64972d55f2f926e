"""One scan per raw table, and the same rows as the operators that build each kind."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, rows
from vouchlake import schemas
from vouchlake.operators import curation, gate

AT = datetime(2025, 1, 1)
DATES = ["2024-01-05", "05-03-2024", "2024/01/05", None, "", "31-02-2024", "2024-02-30", "2024-01-05\n"]


def raw_rows(spark, table):
    """Every date with every order, of known and unknown status."""
    fields, key, date = schemas.RAW[f"{table}_raw"].fieldNames(), gate.RULES[table].key, gate.RULES[table].date
    data = []
    for n, day in enumerate(DATES):
        for k, order in enumerate(["O1", "O2", "O9", None]):
            row = {c: "1.50" if c in ("amount", "refund_amount", "order_total") else "x" for c in fields}
            row |= {"order_id": order, "source_updated_at": "2024-01-06 00:00:00", "row_status": ["PASS", "FAIL", "PASS", None, "FAIL"][(n + k) % 5]}
            row |= {"ingestion_time": AT, date: day}
            row |= {} if key == "order_id" else {key: f"K{n}-{k}"}
            data.append(tuple(row[c] for c in fields))
    # What is neither golden nor logged must not be cast.
    bad = dict(zip(fields, data[0], strict=True)) | {date: None, "order_total": "no number", "amount": "no number", "refund_amount": "no number"}
    return spark.createDataFrame([*data, tuple(bad[c] for c in fields)], schemas.RAW[f"{table}_raw"])


@pytest.fixture
def golden_orders(spark):
    return spark.createDataFrame([("O1",), ("O1",), (None,)], "order_id string")


@pytest.fixture
def log(spark):
    base = {"source_table": "orders_raw", "error_message": schemas.MISSING_INVOICE, "raw_data": "{}", "retry_count": 0, "created_at": AT, "resolved_at": None}
    data = [base | {"record_id": "O1", "resolved_flag": False}, base | {"record_id": "O2", "resolved_flag": True}]
    names = schemas.CURATED["data_error_logs"].fieldNames()
    return spark.createDataFrame([tuple(r[c] for c in names) for r in data], schemas.CURATED["data_error_logs"])


def one_by_one(table, raw, orders, log, bad, missing):
    quarantine = bad == "quarantine"
    if table == "customers":
        return curation.curate_customers(raw, bad), curation.errors_customer_dates(raw, AS_OF, quarantine, missing)
    if table == "orders":
        errors = curation.errors_order_dates(raw, AS_OF, quarantine, missing)
        return curation.curate_orders(raw, bad), errors.unionByName(curation.errors_missing_invoice(raw, log, AS_OF))
    if table == "payments":
        return curation.curate_payments(raw, orders, bad), curation.errors_payment_dates(raw, AS_OF, quarantine, missing)
    if table == "returns":
        return curation.curate_returns(raw, orders, bad), curation.errors_return_dates(raw, AS_OF, quarantine, missing)
    return curation.curate_pdf_manifest(raw, bad), curation.errors_manifest_dates(raw, AS_OF, quarantine, missing)


@pytest.mark.parametrize("table", sorted(gate.RULES))
def test_same_rows_as_one_by_one(spark, golden_orders, log, table):
    raw = raw_rows(spark, table).cache()
    possible = raw.where(f"NOT coalesce({gate.RULES[table].date} IN ('31-02-2024', '2024-02-30'), false)")
    for rows_in, bad, missing in ((raw, "quarantine", True), (possible, "fail", False)):
        got = gate.gated(table, rows_in, AS_OF, golden_orders, log, bad, missing).cache()
        golden, logged = one_by_one(table, rows_in, golden_orders, log, bad, missing)
        assert rows(got.where("tag = 'golden'").select(golden.columns)) == rows(golden) != []
        assert rows(got.where("tag = 'log'").select(logged.columns)) == rows(logged) != []
        assert got.where("tag IS NULL").count() == 0
    with pytest.raises(Exception, match="impossible date"):
        gate.gated(table, raw, AS_OF, golden_orders.unionByName(spark.createDataFrame([("O9",), ("O2",)], "order_id string")), log).collect()


def test_one_scan_and_one_job_for_both_kinds(spark, store, golden_orders, log):
    raw = store.replace("payments_raw", raw_rows(spark, "payments"))
    rows_out = gate.gated("payments", raw, AS_OF, golden_orders, log, "quarantine")
    plan = rows_out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    want = rows_out.cache()
    store.replace_gated("payments_curated", rows_out, "payment_date")
    golden, logged = want.where("tag = 'golden'"), want.where("tag = 'log'")
    assert rows(store.read("payments_curated")) == rows(golden.select(schemas.CURATED["payments_curated"].fieldNames()))
    assert rows(store.rejected("payments_curated")) == rows(logged.select(schemas.CURATED["data_error_logs"].fieldNames()))
    assert store.read_months("payments_curated", "2024-03", "2024-03").count() == golden.where("month(payment_date) = 3").count() > 0


def test_only_golden_only_logged_or_no_rows(spark, store, golden_orders, log):
    raw = raw_rows(spark, "customers")
    for part, n, m in ((raw.where("created_date = '2024-01-05'"), 4, 0), (raw.where("created_date = ''"), 0, 4), (raw.limit(0), 0, 0)):
        store.replace_gated("customers_curated", gate.gated("customers", part, AS_OF))
        assert (store.read("customers_curated").count(), store.rejected("customers_curated").count()) == (n, m)
        assert store.read("customers_curated").columns == schemas.CURATED["customers_curated"].fieldNames()
    assert store.read("customers_curated").agg(F.count("*")).first()[0] == 0
