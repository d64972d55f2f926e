"""Changes that rewrite only the files they touch, and the change feed they leave."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, rows
from vouchlake import schemas
from vouchlake.operators import governance
from vouchlake.operators.upsert import merge_into_raw, raw_images
from vouchlake.sinks import store as store_module
from vouchlake.sinks.store import replayed

OLD = datetime(2025, 1, 1)


def payment(k, amount="1.00", key=None):
    return (key or f"P{k:05d}", f"O{k}", "2024-01-01", "card", amount, "ok")


def raw_payments(spark, keys):
    return spark.createDataFrame([(*payment(k), OLD, "payments.csv") for k in keys], schemas.RAW["payments_raw"])


def stage_payments(spark, data):
    return spark.createDataFrame(data, schemas.STAGE["payments"])


def files_of(store, table):
    return {r["path"] for r in store.live_files(table, schemas.KEYS[table.removesuffix("_raw")]).collect()}


@pytest.fixture
def many_files(spark, store):
    """A table of 64 files by key range."""
    store.replace("payments_raw", raw_payments(spark, range(640)).repartitionByRange(64, "payment_id"))
    assert len(files_of(store, "payments_raw")) == 64
    return store


def merge(store, stage, token=None):
    return store.merge("payments_raw", "payment_id", stage, lambda target: raw_images("payments", target, stage, AS_OF), token)


def test_a_batch_in_one_of_64_files_rewrites_one(spark, many_files):
    store = many_files
    before, table = files_of(store, "payments_raw"), store.read("payments_raw")
    whole = rows(table)
    stage = stage_payments(spark, [payment(315, "9.00"), payment(316, "8.00")])
    expected = rows(merge_into_raw("payments", table, stage, AS_OF))
    merge(store, stage, "run")
    after = files_of(store, "payments_raw")
    assert len(before - after) == 1 and len(after - before) == 1 and store.has_token("payments_raw", "run")
    assert rows(store.read("payments_raw")) == expected != whole
    # Of the new version only new rows are written.
    folder = store.location("payments_raw")
    written = [f for base, _, names in os.walk(folder) for f in (os.path.join(base, n) for n in names) if f.endswith(".parquet") and "image=row" in f]
    assert len(written) == 1 and spark.read.parquet(written[0]).count() == 10


def test_new_and_null_keys_touch_nothing(spark, many_files):
    before = files_of(many_files, "payments_raw")
    stage = stage_payments(spark, [payment(99999), payment(1, key="A"), (None, *payment(1)[1:]), (None, *payment(1)[1:])])
    merge(many_files, stage)
    assert before < files_of(many_files, "payments_raw") and many_files.read("payments_raw").count() == 644
    merge(many_files, stage)  # keyed rows meet, those without key are inserted again
    assert many_files.read("payments_raw").count() == 646
    assert merge(many_files, stage_payments(spark, [])).count() == 646


def test_merge_into_no_table_and_repeated_merges(spark, store):
    first = stage_payments(spark, [payment(k) for k in range(20)])
    merge(store, first)
    assert rows(store.read("payments_raw")) == rows(merge_into_raw("payments", schemas.empty(spark, "payments_raw"), first, AS_OF))
    for k in range(4):
        merge(store, stage_payments(spark, [payment(j, f"{k}.50") for j in range(k, 20, 3)]))
    got = {r.payment_id: r.amount for r in store.read("payments_raw").collect()}
    want = {}
    for k in range(-1, 4):
        want |= {f"P{j:05d}": "1.00" if k < 0 else f"{k}.50" for j in (range(20) if k < 0 else range(k, 20, 3))}
    assert got == want


def test_copies_of_a_stored_key_still_fail(spark, many_files):
    stage = stage_payments(spark, [payment(3, "2.00"), payment(3, "3.00")])
    with pytest.raises(Exception, match="more than one batch row"):
        merge(many_files, stage)
    assert many_files.version("payments_raw") == 1 and many_files.read("payments_raw").count() == 640


def test_crash_before_the_last_line_leaves_the_former_version(spark, many_files, monkeypatch):
    store = many_files
    before = rows(store.read("payments_raw"))
    stage = stage_payments(spark, [payment(5, "7.00")])
    for step in ("_publish", "_mark"):
        with monkeypatch.context() as patch:
            patch.setattr(type(store), step, lambda *a, **k: (_ for _ in ()).throw(OSError("driver lost")))
            with pytest.raises(OSError):
                merge(store, stage, "t")
        assert rows(store.read("payments_raw")) == before and not store.has_token("payments_raw", "t")
    merge(store, stage, "t")
    assert rows(store.read("payments_raw")) == rows(merge_into_raw("payments", raw_payments(spark, range(640)), stage, AS_OF))


def test_large_rewrites_are_cut_into_files_by_range(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "ROWS_PER_FILE", 25)
    merge(store, stage_payments(spark, [payment(k) for k in range(200)]))
    entries = sorted(store.live_files("payments_raw", "payment_id").collect(), key=lambda r: r.low)
    assert len(entries) > 4 and sum(r.rows for r in entries) == 200
    assert all(a.high < b.low for a, b in zip(entries, entries[1:], strict=False))
    merge(store, stage_payments(spark, [payment(0, "2.00")]))
    assert len({r.path for r in entries} - files_of(store, "payments_raw")) == 1


def test_feed_replays_one_version_into_the_other(spark, many_files):
    store = many_files
    states = {store.version("payments_raw"): store.read("payments_raw")}
    merge(store, stage_payments(spark, [payment(k, "5.00") for k in range(0, 700, 50)] + [(None, *payment(1)[1:])] * 2))
    states[store.version("payments_raw")] = store.read("payments_raw")
    store.delete("payments_raw", "payment_id", stage_payments(spark, [payment(k) for k in (0, 7, 8, 90000)]))
    states[store.version("payments_raw")] = store.read("payments_raw")
    store.insert("payments_raw", "payment_id", raw_payments(spark, [8, 8, 1000]))
    states[store.version("payments_raw")] = store.read("payments_raw")
    assert [s.count() for s in states.values()] == [640, 643, 640, 643]
    for a in states:
        for b in states:
            if a <= b:
                assert rows(replayed(states[a], store.changes("payments_raw", a, b))) == rows(states[b])
    images = {(r.version, r.image): r["count"] for r in store.changes("payments_raw", 1).groupBy("version", "image").count().collect()}
    assert images == {(2, "before"): 13, (2, "after"): 13, (2, "insert"): 3, (3, "delete"): 3, (4, "insert"): 3}
    with pytest.raises(ValueError, match="no change feed"):
        store.changes("payments_raw", 0)
    with pytest.raises(Exception, match="not there"):
        replayed(states[3], store.changes("payments_raw", 1, 2)).collect()


def test_rows_without_change_leave_no_image(spark, store):
    order = ("O1", "C1", "2024-01-01", "new", "1.00", "2024-01-02 00:00:00")
    stage = spark.createDataFrame([order], schemas.STAGE["orders"])
    for _ in range(2):
        store.merge("orders_raw", "order_id", stage, lambda target: raw_images("orders", target, stage, AS_OF))
    assert store.version("orders_raw") == 2 and store.changes("orders_raw", 1).count() == 0


def test_status_is_set_in_the_files_of_stale_orders_only(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "ROWS_PER_FILE", 10)
    stage = spark.createDataFrame([(f"O{k:03d}", "C1", "2024-01-01", "new", "1.00", "2024-01-02 00:00:00") for k in range(100)], schemas.STAGE["orders"])
    store.merge("orders_raw", "order_id", stage, lambda target: raw_images("orders", target, stage, AS_OF))
    proven = spark.createDataFrame([("O005", "f", "p", OLD), ("O005", "g", "p", OLD)], schemas.RAW["attachments_raw"])

    def certify():
        stale = governance.stale_status(store.read_filed("orders_raw"), proven)
        return store.change("orders_raw", "order_id", stale, lambda r: governance.status_images(r, proven))

    before = files_of(store, "orders_raw")
    want = rows(governance.governance_status(store.read("orders_raw"), proven))
    assert rows(certify()) == want and len(before - files_of(store, "orders_raw")) == 1
    feed = store.changes("orders_raw", 1).select("image", "order_id", "row_status")
    assert rows(feed) == [("after", "O005", "PASS"), ("before", "O005", "FAIL")]
    certify()
    assert store.version("orders_raw") == 2


def test_prune_keeps_files_that_live_on(spark, many_files):
    store = many_files
    for k in range(6):
        merge(store, stage_payments(spark, [payment(k * 100, f"{k}.00")]), f"t{k}")
    whole = rows(store.read("payments_raw"))
    store.prune("payments_raw", keep=2)
    assert rows(store.read("payments_raw")) == whole and len(store._versions("payments_raw")) == 2
    assert all(store.has_token("payments_raw", f"t{k}") for k in range(6))
    on_disk = [f for base, _, names in os.walk(f"{store.root}/payments_raw/v00000001") for f in names if f.endswith(".parquet")]
    assert len(on_disk) == 64 - 5  # one rewritten by each merge, the last two versions list one of them between them
    merge(store, stage_payments(spark, [payment(k, "1.25") for k in range(640)]))
    store.prune("payments_raw", keep=1)
    assert os.listdir(f"{store.root}/payments_raw") and not os.path.exists(f"{store.root}/payments_raw/v00000001")
    assert store.read("payments_raw").count() == 640


def test_a_table_kept_by_files_can_still_be_written_whole(spark, many_files):
    merge(many_files, stage_payments(spark, [payment(1, "2.00")]))
    many_files.rewrite("payments_raw", lambda r: r.withColumn("amount", F.lit("0")))
    assert many_files.read("payments_raw").select("amount").distinct().count() == 1
    merge(many_files, stage_payments(spark, [payment(1, "2.00")]))
    assert many_files.read("payments_raw").where("amount <> '0'").count() == 1
    with pytest.raises(ValueError, match="kept by files"):
        many_files.append_once("payments_raw", raw_payments(spark, [1]), "b")
