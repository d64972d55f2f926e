"""Drops that keep their name."""

import os
from datetime import datetime

import pytest

from tests.conftest import AS_OF, rows
from tests.test_files import write
from vouchlake.sinks.store import TableStore
from vouchlake.streaming import rewritten
from vouchlake.streaming.rewritten import ingest_rewritten

HEAD = "payment_id,order_id,payment_date,payment_method,amount,payment_status\n"


def drop(path, moment, *payments):
    write(path, HEAD + "".join(f"{key},O1,2024-01-01,card,{amount},ok\n" for key, amount in payments))
    os.utime(path, (moment, moment))


def amounts(df):
    return {r.payment_id: r.amount for r in df.collect()}


def test_a_file_written_again_is_merged_once(spark, store, tmp_path):
    name, checkpoint = f"{tmp_path}/in/payments.csv", f"{tmp_path}/checkpoint"

    def run(at=AS_OF):
        return ingest_rewritten(spark, store, "payments", f"{tmp_path}/in", checkpoint, at)

    drop(name, 1_700_000_000, ("P1", "1.00"), ("P2", "2.00"))
    assert amounts(run()) == {"P1": "1.00", "P2": "2.00"}
    version = store.version("payments_raw")
    run()  # nothing new
    assert store.version("payments_raw") == version
    drop(name, 1_700_000_100, ("P2", "2.50"), ("P3", "3.00"))
    assert amounts(run()) == {"P1": "1.00", "P2": "2.50", "P3": "3.00"}
    # Another name, and a name with characters that addresses encode.
    drop(f"{tmp_path}/in/sub/pay ments+1.csv", 1_700_000_200, ("P4", "4.00"))
    write(f"{tmp_path}/in/notes.txt", "no drop")
    assert amounts(run())["P4"] == "4.00" and store.version("payments_raw") == version + 2
    # The same length and another time, then the same time and another length.
    drop(name, 1_700_000_300, ("P2", "9.50"), ("P3", "3.00"))
    assert amounts(run())["P2"] == "9.50"
    drop(name, 1_700_000_300, ("P2", "19.50"), ("P3", "3.00"))
    assert amounts(run())["P2"] == "19.50" and store.version("payments_raw") == version + 4
    # A drop that was archived and comes again.
    os.remove(name)
    run()
    drop(name, 1_700_000_300, ("P2", "19.50"), ("P3", "3.00"))
    assert store.version("payments_raw") == version + 4 and amounts(run())["P2"] == "19.50"


def test_restart_after_a_crash_merges_nothing_twice(spark, store, tmp_path, monkeypatch):
    def run():
        return ingest_rewritten(spark, store, "payments", f"{tmp_path}/in", f"{tmp_path}/checkpoint", AS_OF)

    # Rows without key would be inserted again.
    drop(f"{tmp_path}/in/payments.csv", 1_700_000_000, ("", "1.00"), ("P2", "2.00"))
    merge = rewritten.merge_drops

    def crash(*args):
        merge(*args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(rewritten, "merge_drops", crash)
        with pytest.raises(Exception, match="driver lost"):
            run()
    assert run().count() == 2 and store.version("payments_raw") == 1
    # Another stream, or a checkpoint made anew, reads what is there.
    other = ingest_rewritten(spark, TableStore(spark, f"{tmp_path}/other"), "payments", f"{tmp_path}/in", f"{tmp_path}/second", AS_OF)
    assert other.count() == 2


def test_a_file_written_between_listing_and_reading_waits(spark, tmp_path):
    name = f"{tmp_path}/in/payments.csv"
    drop(name, 1_700_000_000, ("P1", "1.00"))
    drop(f"{tmp_path}/in/b.csv", 1_700_000_000, ("P2", "2.00"))
    listed = [("payments.csv", 1_700_000_000_000, os.path.getsize(name)), ("b.csv", 1_700_000_000_000, os.path.getsize(f"{tmp_path}/in/b.csv")), ("gone.csv", 1, 1)]
    listed = spark.createDataFrame(listed, "path string, moment long, length long")
    drop(name, 1_700_000_500, ("P1", "7.00"))
    found = rewritten.read_as_listed(spark, "payments", f"{tmp_path}/in", listed)
    assert rows(found.select("payment_id")) == [("P2",)]
    assert rewritten.read_as_listed(spark, "payments", f"{tmp_path}/in", listed.where("path = 'gone.csv'")) is None


def test_order_versions_decide_between_files(spark, store, tmp_path):
    head = "order_id,customer_id,order_date,order_status,order_total,source_updated_at\n"
    for name, total, at in (("a", "5.00", "2024-01-05"), ("b", "4.00", "2024-01-04")):
        write(f"{tmp_path}/in/{name}.csv", f"{head}O1,C1,2024-01-01,new,{total},{at} 00:00:00\n")
    got = ingest_rewritten(spark, store, "orders", f"{tmp_path}/in", f"{tmp_path}/ck", datetime(2024, 2, 1))
    assert [r.order_total for r in got.collect()] == ["5.00"]
