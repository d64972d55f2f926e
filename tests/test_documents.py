from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import AS_OF, rows
from vouchlake import schemas
from vouchlake.operators import curation, governance, linking, remediation

FILES = [
    ("landing/unstructured/invoice_O1_20240101.pdf", "O1", "valid"),
    ("landing/unstructured/more/invoice_O1_20240102.pdf", "O1", "valid"),
    ("landing/unstructured/invoice_O2_20240101.PDF", None, "invalid"),
    ("landing/unstructured/report.pdf", None, "invalid"),
    ("landing/unstructured/invoice_O7_20240101.pdf", "O7", "orphan"),
    ("landing/unstructured/", None, "ignored"),
    ("landing/unstructured/notes.txt", None, "ignored"),
]


def listing(spark, paths):
    return spark.createDataFrame([(p, datetime(2026, 1, 1), 1) for p in paths], "path string, modificationTime timestamp, length long")


def orders(spark, data):
    blank = [(k, "C1", "2024-01-01", "s", "1.0", "2024-01-01 00:00:00", status, AS_OF, "f") for k, status in data]
    return spark.createDataFrame(blank, schemas.RAW["orders_raw"])


def log(spark, data):
    full = [(i, t, m, "{}", 0, AS_OF, done, None) for i, t, m, done in data]
    return spark.createDataFrame(full, schemas.CURATED["data_error_logs"])


def test_each_file_lands_in_one_class(spark):
    known = orders(spark, [("O1", "FAIL"), ("O1", "FAIL"), ("O2", "FAIL"), (None, "FAIL")])
    found = linking.classify_documents(listing(spark, [f[0] for f in FILES]), known)
    assert rows(found.select("path", "order_id", "outcome")) == sorted(FILES, key=repr)
    dest = {r.path: r.dest_path for r in found.collect()}
    assert dest["landing/unstructured/more/invoice_O1_20240102.pdf"] == "archive/pdfs/invoice_O1_20240102.pdf"
    assert dest["landing/unstructured/report.pdf"] == "error/pdfs/report.pdf"
    assert dest["landing/unstructured/notes.txt"] is None

    assert rows(linking.link_attachments(found, "store://v/", AS_OF)) == [
        ("O1", f"invoice_O1_2024010{i}.pdf", f"store://v/archive/pdfs/invoice_O1_2024010{i}.pdf", AS_OF) for i in (1, 2)
    ]
    assert rows(linking.orphan_documents(found, "store://v", AS_OF)) == [
        ("invoice_O7_20240101.pdf", "O7", "store://v/error/pdfs/invoice_O7_20240101.pdf", AS_OF, "Order ID not found")
    ]
    both = linking.errors_invalid_documents(found, AS_OF).unionByName(linking.errors_orphan_documents(found, AS_OF))
    assert rows(both) == rows(linking.document_errors(found, AS_OF))
    assert {r.raw_data for r in both.collect()} == {
        '{"file_name":"invoice_O2_20240101.PDF"}',
        '{"file_name":"report.pdf"}',
        '{"file_name":"invoice_O7_20240101.pdf","order_id":"O7"}',
    }


def test_governance(spark):
    held = orders(spark, [("O1", "FAIL"), ("O2", "PASS"), ("O3", "FAIL"), (None, "PASS")])
    attached = spark.createDataFrame(
        [("O1", "a", "g", AS_OF), ("O1", "b", "g", AS_OF), ("O3", "c", "g", AS_OF), ("O9", "d", "g", AS_OF), (None, "e", "g", AS_OF)],
        schemas.RAW["attachments_raw"],
    )
    got = governance.governance_status(held, attached)
    assert rows(got.select("order_id", "row_status")) == sorted(
        [("O1", "PASS"), ("O2", "FAIL"), ("O3", "PASS"), (None, "FAIL")], key=repr
    )
    assert got.columns == held.columns


def test_missing_invoice_is_logged_once(spark):
    held = orders(spark, [("O1", "FAIL"), ("O2", "FAIL"), ("O3", "FAIL"), ("O4", "FAIL"), ("O5", "PASS"), (None, "FAIL")])
    old = log(
        spark,
        [
            ("O1", "orders_raw", schemas.MISSING_INVOICE, False),
            ("O2", "orders_raw", schemas.MISSING_INVOICE, True),
            ("O3", "orders_raw", "Invalid order_date format", False),
            ("O4", "other", schemas.MISSING_INVOICE, False),
        ],
    )
    fresh = curation.errors_missing_invoice(held, old, AS_OF)
    assert rows(fresh.select("record_id")) == sorted([("O2",), ("O3",), ("O4",), (None,)], key=repr)
    again = curation.errors_missing_invoice(held.filter("order_id is not null"), old.unionByName(fresh), AS_OF)
    assert again.count() == 0


def test_late_documents(spark):
    old = log(
        spark,
        [
            ("O1", "orders_raw", schemas.MISSING_INVOICE, False),
            ("O2", "orders_raw", schemas.MISSING_INVOICE, True),
            ("O1", "orders_raw", "Invalid order_date format", False),
            ("O3", "orders_raw", schemas.MISSING_INVOICE, False),
        ],
    )
    files = [f"z/invoice_O{i}_20240101.pdf" for i in (1, 2, 4)] + ["z/invoice_O1_20240102.pdf", "z/odd.pdf", "z/"]
    found = remediation.recover_late_documents(listing(spark, files), old)
    assert rows(found.select("path", "dest_path")) == [
        (f"z/invoice_O1_2024010{i}.pdf", f"archive/pdfs/invoice_O1_2024010{i}.pdf") for i in (1, 2)
    ]
    closed = remediation.resolve_error_logs(old, found, AS_OF)
    assert rows(closed.select("record_id", "error_message", "resolved_flag", "resolved_at")) == sorted(
        [
            ("O1", schemas.MISSING_INVOICE, True, AS_OF),
            ("O2", schemas.MISSING_INVOICE, True, None),
            ("O1", "Invalid order_date format", False, None),
            ("O3", schemas.MISSING_INVOICE, False, None),
        ],
        key=repr,
    )
    assert closed.schema == old.schema
    held = orders(spark, [("O1", "FAIL"), ("O2", "FAIL"), ("O3", "PASS")])
    reset = remediation.reset_recovered_orders(held, found)
    assert rows(reset.select("order_id", "row_status")) == [("O1", "PASS"), ("O2", "FAIL"), ("O3", "PASS")]
    nothing = remediation.recover_late_documents(listing(spark, files), old.filter(F.lit(False)))
    assert nothing.count() == 0
