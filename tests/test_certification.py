"""The whole flow on files: ingest, certify, curate, marts, late documents."""

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA, rows
from tests.test_files import write
from vouchlake import schemas
from vouchlake.operators.keys import without
from vouchlake.plans import certification as flow
from vouchlake.plans.testbed import Testbed, write_files
from vouchlake.sinks.store import TableStore

NOW = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(hours=1)
LATER = NOW + timedelta(days=1)


def workspace(spark, tmp_path, **options):
    root = str(tmp_path / "files")
    for zone in (schemas.LANDING_CSV, schemas.LANDING_PDF):
        os.makedirs(f"{root}/{zone}", exist_ok=True)
    return flow.Workspace(spark, root, TableStore(spark, str(tmp_path / "tables")), "store://v", **options)


def land(ws, table, *lines):
    head = ",".join(schemas.STAGE[table].fieldNames())
    write(f"{ws.files_root}/{schemas.LANDING_CSV}/{schemas.STAGE_FILES[table]}", "\n".join((head,) + lines) + "\n")


def documents(ws, *names):
    for name in names:
        write(f"{ws.files_root}/{schemas.LANDING_PDF}/{name}", "%PDF")


def stored_files(ws, zone):
    folder = f"{ws.files_root}/{zone}"
    return sorted(os.listdir(folder)) if os.path.exists(folder) else []


def test_small_story(spark, tmp_path):
    ws = workspace(spark, tmp_path)
    land(ws, "customers", "C1,Ann,a@x,1,01-02-2020,IN", "C2,Bo,b@x,2,2020/01/01,IN", "C3,Cy,c@x,3,,IN")
    land(
        ws, "orders", "O1,C1,2024-01-05,new,60000.00,2024-01-06 00:00:00", "O2,C1,05-03-2024,new,10.50,2024-03-06 00:00:00",
        "O3,C2,2024/01/05,new,5.00,2024-01-06 00:00:00", "O4,C1,2024-01-07,new,7.00,2024-01-08 00:00:00",
    )
    land(ws, "order_items", "I1,O1,P1,pen,2,1.50", "I2,O2,P1,pen,1,1.50", "I3,O4,P2,ink,1,3.00")
    land(ws, "returns", "R1,O1,2024-01-20,late,1.00", "R2,O4,2024/01/20,late,1.00")
    documents(ws, "invoice_O1_20240105.pdf", "invoice_O3_20240105.pdf", "invoice_O9_20240105.pdf", "scan.pdf", "note.txt")
    flow.certified_run(ws, NOW, "run1")
    t = ws.tables

    assert stored_files(ws, schemas.LANDING_CSV) == [] and len(stored_files(ws, schemas.PROCESSED)) == 4
    assert stored_files(ws, schemas.LANDING_PDF) == ["note.txt"]
    assert stored_files(ws, schemas.ARCHIVE_PDF) == ["invoice_O1_20240105.pdf", "invoice_O3_20240105.pdf"]
    assert stored_files(ws, schemas.ERROR_PDF) == ["invoice_O9_20240105.pdf", "scan.pdf"]
    assert rows(t.read("orders_raw").select("order_id", "row_status")) == [("O1", "PASS"), ("O2", "FAIL"), ("O3", "PASS"), ("O4", "FAIL")]
    assert rows(t.read("orders_curated").select("order_id")) == [("O1",)]
    assert rows(t.read("customers_curated").select("customer_id")) == [("C1",)]
    log = t.read("data_error_logs").select("record_id", "error_message", "resolved_flag")
    assert rows(log) == sorted(
        [
            ("scan.pdf", "Invalid PDF filename format", False),
            ("O9", "Order ID missing in Orders", False),
            ("C2", "Invalid created_date format", False),
            ("O3", "Invalid order_date format", False),
            ("O2", "Missing Invoice PDF", False),
            ("O4", "Missing Invoice PDF", False),
            ("R2", "Invalid return_date format", False),
        ],
        key=repr,
    )
    assert rows(t.read("orphan_pdfs").select("order_id")) == [("O9",)]
    assert rows(t.read("customer_segments")) == [("C1", 60000.0, 1, "HIGH_VALUE")]
    assert rows(t.read("product_returns")) == [("P1", 2, 1, 0.5)]

    # The same run once more adds nothing.
    before = rows(t.read("data_error_logs")), rows(t.read("attachments_raw")), rows(t.read("orders_raw"))
    flow.certified_run(ws, NOW, "run1")
    assert (rows(t.read("data_error_logs")), rows(t.read("attachments_raw")), rows(t.read("orders_raw"))) == before

    documents(ws, "invoice_O2_20240305.pdf", "invoice_O2_20240306.pdf", "invoice_O3_20240109.pdf")
    flow.remediation_run(ws, LATER, "run2")
    assert stored_files(ws, schemas.LANDING_PDF) == ["invoice_O3_20240109.pdf", "note.txt"]
    assert rows(t.read("orders_curated").select("order_id")) == [("O1",), ("O2",)]
    closed = t.read("data_error_logs").filter("resolved_flag")
    assert rows(closed.select("record_id", "resolved_at")) == [("O2", LATER)]
    assert rows(t.read("customer_clv").select("total_orders", "clv_amount")) == [(2, 60010.5)]
    assert t.read("attachments_raw").filter("order_id = 'O2'").count() == 2


def test_rerun_after_a_crash_between_plan_and_moves(spark, tmp_path, monkeypatch):
    ws = workspace(spark, tmp_path)
    land(ws, "orders", "O1,C1,2024-01-05,new,1.00,2024-01-06 00:00:00")
    documents(ws, "invoice_O1_20240105.pdf")

    def crash(*args, **options):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(flow, "apply_moves", crash)
        try:
            flow.ingest_and_link(ws, NOW, "run1")
        except RuntimeError:
            pass
        try:
            flow.link_documents(ws, NOW, "run1")
        except RuntimeError:
            pass
    # One more document arrives before the run is repeated: it waits.
    documents(ws, "invoice_O1_20240106.pdf")
    flow.ingest_and_link(ws, NOW, "run1")
    assert ws.tables.read("attachments_raw").count() == 1
    assert ws.tables.read("orders_raw").count() == 1
    assert stored_files(ws, schemas.LANDING_PDF) == ["invoice_O1_20240106.pdf"]
    flow.ingest_and_link(ws, LATER, "run2")
    assert ws.tables.read("attachments_raw").count() == 2
    assert stored_files(ws, schemas.LANDING_PDF) == []


def test_driver_tables_end_to_end(spark, tmp_path):
    ws = workspace(spark, tmp_path, money_scale=2)
    bed = Testbed(spark, f"{TESTDATA}/sf0.001")
    for table in schemas.STAGE:
        fields = schemas.STAGE[table].fieldNames()
        drop = f"{ws.files_root}/{schemas.LANDING_CSV}/{schemas.STAGE_FILES[table]}"
        getattr(bed, f"{table}_raw")().select(fields).write.csv(drop, header=True)
    write_files(bed.landing_documents(), ws.files_root)
    flow.certified_run(ws, NOW, "wave1")
    t = ws.tables
    n = t.read("orders_raw").count()
    passed = t.read("orders_raw").filter("row_status = 'PASS'").count()
    assert (n, passed) == (1500, 1290)
    assert t.read("attachments_raw").count() == 1320
    missing = t.read("data_error_logs").filter(F.col("error_message") == schemas.MISSING_INVOICE)
    assert missing.count() == n - passed
    for child in ("order_items", "payments", "returns", "attachments"):
        assert without(t.read(f"{child}_curated"), t.read("orders_curated"), "order_id", "order_id").count() == 0
    first = t.read("monthly_sales").agg(F.sum("total_orders")).first()[0]
    assert first == t.read("orders_curated").count()

    write_files(bed.late_documents(), ws.files_root)
    flow.remediation_run(ws, LATER, "wave2")
    assert t.read("orders_raw").filter("row_status = 'PASS'").count() == passed + 75
    assert t.read("data_error_logs").filter("resolved_flag").count() == 75
    assert t.read("monthly_sales").agg(F.sum("total_orders")).first()[0] > first
    # Everything is in the table the summary lists, with the types declared.
    assert {r.table_name for r in flow.summary(ws).collect()} == set(schemas.TABLES)
    for name, schema in schemas.TABLES.items():
        stored = {f.name: f.dataType for f in t.read(name).schema}
        assert stored == {f.name: f.dataType for f in schema}, name


def test_inventory_replaces_the_live_listing(spark, tmp_path):
    ws = workspace(spark, tmp_path)
    land(ws, "orders", "O1,C1,2024-01-05,new,1.00,2024-01-06 00:00:00")
    documents(ws, "invoice_O1_20240105.pdf", "invoice_O1_20240106.pdf")
    live = ws.listing

    def inventory(zone):
        ws.inventory = None
        listed = live(zone).filter(~F.col("path").contains("20240106"))
        ws.inventory = inventory
        return listed

    ws.inventory = inventory
    flow.ingest_and_link(ws, NOW, "run1")
    assert ws.tables.read("attachments_raw").count() == 1
    assert stored_files(ws, schemas.LANDING_PDF) == ["invoice_O1_20240106.pdf"]


def test_colliding_documents_store_nothing(spark, tmp_path):
    ws = workspace(spark, tmp_path)
    land(ws, "orders", "O1,C1,2024-01-05,new,1.00,2024-01-06 00:00:00")
    documents(ws, "a/invoice_O1_20240105.pdf", "b/invoice_O1_20240105.pdf")
    with pytest.raises(ValueError, match="2 files would move to archive/pdfs/invoice_O1_20240105.pdf"):
        flow.ingest_and_link(ws, NOW, "run1")
    assert ws.tables.read("attachments_raw").count() == 0
    os.rename(f"{ws.files_root}/{schemas.LANDING_PDF}/b/invoice_O1_20240105.pdf", f"{ws.files_root}/{schemas.LANDING_PDF}/b/invoice_O1_20240106.pdf")
    flow.ingest_and_link(ws, NOW, "run2")
    assert ws.tables.read("attachments_raw").count() == 2
