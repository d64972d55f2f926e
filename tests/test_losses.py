"""Nothing is lost or applied twice when runs, streams and appends are repeated."""

import os
import shutil
from datetime import datetime, timedelta, timezone

import pytest

from tests.conftest import AS_OF, rows
from tests.test_certification import LATER, NOW, documents, land, stored_files, workspace
from vouchlake import schemas
from vouchlake.plans import certification as flow
from vouchlake.streaming.drops import ingest_incremental

HEADER = "payment_id,order_id,payment_date,payment_method,amount,payment_status\n"


def drop(folder, name, *lines, age=0):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write(HEADER + "".join(f"{line}\n" for line in lines))
    moment = (datetime.now(timezone.utc) - timedelta(seconds=age)).timestamp()
    os.utime(f"{folder}/{name}", (moment, moment))


def payment(key, method):
    return f"{key},O1,2024-01-01,{method},1.00,settled"


def ids(df):
    return [r[0] for r in rows(df.select("payment_id"))]


def test_streams_whose_checkpoints_share_a_name(spark, store, tmp_path):
    drop(f"{tmp_path}/a", "one.csv", payment("P1", "card"))
    drop(f"{tmp_path}/b", "two.csv", payment("P2", "card"))
    ingest_incremental(spark, store, "payments", f"{tmp_path}/a", f"{tmp_path}/ckA/payments")
    got = ingest_incremental(spark, store, "payments", f"{tmp_path}/b", f"{tmp_path}/ckB/payments")
    assert ids(got) == ["P1", "P2"]


def test_a_checkpoint_made_anew_starts_over(spark, store, tmp_path):
    drop(f"{tmp_path}/a", "one.csv", payment("P1", "card"))
    ingest_incremental(spark, store, "payments", f"{tmp_path}/a", f"{tmp_path}/ck")
    shutil.move(f"{tmp_path}/ck", f"{tmp_path}/old-ck")
    drop(f"{tmp_path}/a", "two.csv", payment("P2", "card"))
    assert ids(ingest_incremental(spark, store, "payments", f"{tmp_path}/a", f"{tmp_path}/ck")) == ["P1", "P2"]


def test_waiting_files_make_one_merge_and_the_newest_wins(spark, store, tmp_path):
    folder = f"{tmp_path}/a"
    drop(folder, "z.csv", payment("P1", "old"), payment("P2", "old"), age=100)
    drop(folder, "a.csv", payment("P1", "new"), age=10)
    drop(folder, "m.csv", payment("P3", "mid"), payment("P3", "mid"), age=50)
    got = ingest_incremental(spark, store, "payments", folder, f"{tmp_path}/ck", AS_OF)
    assert rows(got.select("payment_id", "payment_method")) == [("P1", "new"), ("P2", "old"), ("P3", "mid"), ("P3", "mid")]
    assert len(store._versions("payments_raw")) == 1


def test_two_files_of_one_time_with_one_key_fail(spark, store, tmp_path):
    drop(f"{tmp_path}/a", "x.csv", payment("P1", "one"), age=10)
    drop(f"{tmp_path}/a", "y.csv", payment("P1", "two"), age=10)
    for name in ("x.csv", "y.csv"):
        os.utime(f"{tmp_path}/a/{name}", (1_700_000_000, 1_700_000_000))
    with pytest.raises(Exception, match="files of one time bring key P1"):
        ingest_incremental(spark, store, "payments", f"{tmp_path}/a", f"{tmp_path}/ck")


def test_tokens_outlive_pruned_versions(spark, store):
    for k in range(4):
        store.replace("t", spark.range(k), token=f"run-{k}")
    store.prune("t", keep=1)
    assert len(store._versions("t")) == 1 and all(store.has_token("t", f"run-{k}") for k in range(4))
    assert not store.has_token("t", "run-9")


def test_append_whose_writer_died_before_the_marker(spark, store):
    assert store.append_once("log", spark.range(3), "b1")
    os.remove(f"{store.location('log')}/_SUCCESS")
    assert not store.exists("log")
    assert store.append_once("log", spark.range(3), "b1") is False
    assert store.read("log").count() == 3


def test_compaction_keeps_rows_and_names(spark, store):
    for k in range(6):
        store.append_once("log", spark.range(k, k + 1), f"run{k}-curate")
    store.compact("log", keep="run5", batch_count=3)
    folder = store.location("log")
    assert sorted(n for n in os.listdir(folder) if n.startswith("batch=")) == ["batch=b-folded", "batch=b-run5-curate"]
    assert [r[0] for r in rows(store.read("log"))] == list(range(6))
    assert store.append_once("log", spark.range(1), "run2-curate") is False
    assert store.append_once("log", spark.range(9, 10), "run9-curate") and store.read("log").count() == 7


def test_months_are_folders(spark, store):
    df = spark.sql("SELECT id, date_add(DATE'2024-01-15', CAST(id * 20 AS INT)) AS day FROM range(10)")
    assert rows(store.replace("t", df, month_of="day")) == rows(df)
    few = store.read_months("t", "2024-02", "2024-03")
    assert rows(few) == rows(df.where("day BETWEEN '2024-02-01' AND '2024-03-31'"))
    assert "PartitionFilters: [isnotnull(month_of" in few._jdf.queryExecution().executedPlan().toString()


def test_a_csv_written_again_between_try_and_retry_waits(spark, tmp_path, monkeypatch):
    ws = workspace(spark, tmp_path)
    land(ws, "orders", "O1,C1,2024-01-05,new,1.00,2024-01-06 00:00:00")

    def crash(*args, **options):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(flow, "apply_moves", crash)
        with pytest.raises(RuntimeError):
            flow.ingest_and_link(ws, NOW, "run1")
    # The same place holds another file now, which the first try has not merged.
    land(ws, "orders", "O2,C1,2024-01-05,new,1.00,2024-01-06 00:00:00")
    ahead = NOW.timestamp() - 5 if NOW.timestamp() < datetime.now().timestamp() else datetime.now().timestamp() + 30
    for place, _, names in os.walk(f"{ws.files_root}/{schemas.LANDING_CSV}"):
        for name in names:
            os.utime(f"{place}/{name}", (ahead, ahead))
    flow.ingest_and_link(ws, LATER, "run1")
    assert rows(ws.tables.read("orders_raw").select("order_id")) == [("O1",)]
    assert stored_files(ws, schemas.LANDING_CSV) != []
    flow.ingest_and_link(ws, LATER, "run2")
    assert rows(ws.tables.read("orders_raw").select("order_id")) == [("O1",), ("O2",)]


def test_one_run_id_for_both_kinds_of_run(spark, tmp_path):
    ws = workspace(spark, tmp_path)
    land(ws, "customers", "C1,Ann,e,p,2024-13,FR")
    land(ws, "orders", "O1,C1,2024-01-05,new,1.00,2024-01-06 00:00:00")
    flow.certified_run(ws, NOW, "day")
    first = ws.tables.read("data_error_logs").count()
    flow.remediation_run(ws, LATER, "day")
    # The date error is logged by each run; the open missing invoice is not logged again.
    assert (first, ws.tables.read("data_error_logs").count()) == (2, 3)


def test_log_options(spark, tmp_path):
    ws = workspace(spark, tmp_path, log_missing_dates=True, only_new_errors=True, close_open_logs=True)
    land(ws, "customers", "C1,Ann,e,p,,FR", "C2,Bob,e,p,2024/01/01,FR")
    land(ws, "orders", "O1,C1,2024-01-05,new,1.00,2024-01-06 00:00:00")
    flow.certified_run(ws, NOW, "run1")
    documents(ws, "invoice_O1_20240105.pdf")
    flow.certified_run(ws, LATER, "run2")
    log = ws.tables.read("data_error_logs").select("record_id", "error_message", "resolved_flag")
    assert rows(log) == [
        ("C1", "Missing created_date", False),
        ("C2", "Invalid created_date format", False),
        ("O1", schemas.MISSING_INVOICE, True),
    ]
