import collections
import errno
import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, rows
from vouchlake.plans import checks, testbed
from vouchlake.plans.demo_load import load_files
from vouchlake.plans.testbed import write_files
from vouchlake.session import prepare
from vouchlake.sinks.moves import apply_moves, require_moved, plan_csv_archive
from vouchlake.sinks.store import row_counts
from vouchlake.sources import csv_drops, landing
from vouchlake.streaming.drops import ingest_incremental


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


HEAD = "a,b,c,d\n"


def test_fixed_csv_cells(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    write(path, HEAD + 'f1,,"",2024-01-01\n"x, ""y""",O1, t ,"a\\"\n')
    assert rows(csv_drops.scan_csv_fixed(spark, "pdf_manifest", path)) == [
        ("f1", None, "", "2024-01-01"),
        ('x, "y"', "O1", " t ", "a\\"),
    ]


@pytest.mark.parametrize("line", ["a,b,c\n", "a,b,c,d,e\n"])
def test_fixed_csv_wrong_width_fails(spark, tmp_path, line):
    path = str(tmp_path / "m.csv")
    write(path, HEAD + line)
    with pytest.raises(Exception):
        csv_drops.scan_csv_fixed(spark, "pdf_manifest", path).collect()
    with pytest.raises(Exception):
        csv_drops.scan_csv_fixed(spark, "pdf_manifest", path).count()


def test_fixed_csv_header_only(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    write(path, HEAD)
    assert csv_drops.scan_csv_fixed(spark, "pdf_manifest", path).count() == 0


def test_inferred_csv(spark, tmp_path):
    path = str(tmp_path / "i.csv")
    write(
        path,
        "whole,gap,real,flag,flag_gap,day,none,huge,padded,word.dot\n"
        "1,1,1.5,True,True,2023-01-15,,99999999999999999999, 7,a\n"
        "2,NA,-2e3,False,,2023-02-10,NaN,1, 8,b\n"
        "3,3,.5,true,False,x,null,2, 9,\n",
    )
    df = csv_drops.scan_csv_inferred(spark, path)
    kinds = dict(df.dtypes)
    assert kinds == {
        "whole": "bigint", "gap": "double", "real": "double", "flag": "bigint", "flag_gap": "string", "day": "string",
        "none": "double", "huge": "string", "padded": "bigint", "word.dot": "string",
    }
    assert rows(df)[0] == (1, 1.0, 1.5, 1, "1", "2023-01-15", None, "99999999999999999999", 7, "a")
    assert rows(df)[1][1] is None and rows(df)[2][3] == 1


def test_listing_and_present_tables(spark, tmp_path):
    root = str(tmp_path)
    for name in ("landing/structured/orders.csv", "landing/structured/returns.csv/part-1.csv", "landing/structured/returns.csv/part-2.csv",
                 "landing/structured/deep/customers.csv", "landing/structured/other.csv", "landing/structured/payments.csv.tmp"):
        write(f"{root}/{name}", "x\n")
    files = landing.relative_to(landing.list_landing(spark, f"{root}/landing"), root)
    assert files.filter(F.col("path").startswith("landing/")).count() == 6
    assert rows(csv_drops.present_tables(files)) == [
        ("orders", "landing/structured/orders.csv"),
        ("returns", "landing/structured/returns.csv"),
    ]


def test_listing_leaves_no_name_out(spark, tmp_path):
    names = ["_bad.pdf", ".bad.pdf", "_sub/x.pdf", ".d/e/f.txt", "plain.pdf", "a/b/c/deep.PDF"]
    for name in names:
        write(f"{tmp_path}/{name}", "x" * len(name))
    got = landing.relative_to(landing.list_landing(spark, str(tmp_path)), str(tmp_path))
    assert {r.path: r.length for r in got.collect()} == {n: len(n) for n in names}
    assert got.filter(F.col("modificationTime").isNull()).count() == 0
    only = landing.relative_to(landing.list_landing(spark, str(tmp_path), "*.pdf"), str(tmp_path))
    assert {r.path for r in only.collect()} == {n for n in names if n.endswith(".pdf")}
    assert landing.list_landing(spark, f"{tmp_path}/nowhere").count() == 0


def test_inferred_rows_that_do_not_fit(spark, tmp_path):
    write(f"{tmp_path}/short.csv", "a,b\n1,2\n3\n")
    assert rows(csv_drops.scan_csv_inferred(spark, f"{tmp_path}/short.csv")) == [(1, 2.0), (3, None)]
    write(f"{tmp_path}/wide.csv", "a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="wider than the header"):
        csv_drops.scan_csv_inferred(spark, f"{tmp_path}/wide.csv").collect()
    write(f"{tmp_path}/broken.csv", 'a,b\n1,"two\nlines"\n2,one\n')
    assert rows(csv_drops.scan_csv_inferred(spark, f"{tmp_path}/broken.csv")) == [(1, "two\nlines"), (2, "one")]


def test_moves_never_overwrite(spark, tmp_path):
    root = str(tmp_path)
    plan = spark.createDataFrame([(f"in/{n}", f"out/{n}", "z") for n in "abc"], "source_path string, dest_path string, zone string")
    for name in ("in/a", "in/b", "out/b"):
        write(f"{root}/{name}", name)
    tally = apply_moves(plan, root)
    assert tally == {("z", "moved"): 1, ("z", "taken"): 1, ("z", "missing"): 1}
    assert open(f"{root}/out/b").read() == "out/b" and open(f"{root}/in/b").read() == "in/b"
    with pytest.raises(RuntimeError, match="taken"):
        require_moved(tally)
    with pytest.raises(RuntimeError):
        require_moved({("z", "missing"): 1})
    require_moved({("z", "missing"): 1, ("z", "changed"): 2}, tolerated=("missing",))


def test_archive_only_files_older_than_the_run(spark, tmp_path):
    root, now = str(tmp_path), datetime(2026, 1, 1, 12)
    for name, age in (("orders.csv", 60), ("late.csv", 0), ("orders.txt", 60)):
        path = f"{root}/landing/structured/{name}"
        write(path, "x")
        moment = (now - timedelta(seconds=age)).timestamp()
        os.utime(path, (moment, moment))
    files = landing.relative_to(landing.list_landing(spark, root), root)
    plan = plan_csv_archive(files, now)
    assert rows(plan) == [("landing/structured/orders.csv", "processed/orders_20260101T115900.csv", "processed")]
    plan = spark.createDataFrame(plan.collect(), plan.schema)
    assert apply_moves(plan, root) == {("processed", "moved"): 1}
    assert os.path.exists(f"{root}/processed/orders_20260101T115900.csv")
    # A repeated task finds its work done; a lost file is told apart.
    assert apply_moves(plan, root) == {("processed", "done_before"): 1}
    gone = plan.withColumn("source_path", F.lit("nowhere")).withColumn("dest_path", F.lit("nothing"))
    assert apply_moves(gone, root) == {("processed", "missing"): 1}


def test_collisions_stop_before_the_first_move(spark, tmp_path):
    root = str(tmp_path)
    for name in ("a/x.pdf", "b/x.pdf"):
        write(f"{root}/{name}", "x")
    plan = spark.createDataFrame([("a/x.pdf", "z/x.pdf", "z"), ("b/x.pdf", "z/x.pdf", "z")], "source_path string, dest_path string, zone string")
    with pytest.raises(ValueError):
        apply_moves(plan, root)
    assert os.path.exists(f"{root}/a/x.pdf") and not os.path.exists(f"{root}/z")


def test_store_refresh_from_itself_and_failed_refresh(spark, store):
    store.replace("t", spark.range(5))
    store.replace("t", store.read("t").filter("id > 2"))
    assert rows(store.read("t")) == [(3,), (4,)]
    with pytest.raises(Exception):
        store.replace("t", spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")))
    assert rows(store.read("t")) == [(3,), (4,)]
    store.prune("t", keep=1)
    assert rows(store.read("t")) == [(3,), (4,)]
    assert len(store._versions("t")) == 1


def test_store_append_once_and_rewrite(spark, store):
    one = spark.createDataFrame([("O1", "f", "g", AS_OF)], "order_id string, file_name string, gcs_path string, ingestion_time timestamp")
    assert store.read("attachments_raw").count() == 0
    assert store.append_once("attachments_raw", one, "1")
    assert not store.append_once("attachments_raw", one, "1")
    assert store.append_once("attachments_raw", one.limit(0), "2")
    assert store.append_once("attachments_raw", one, "3")
    assert store.read("attachments_raw").columns == one.columns
    assert store.read("attachments_raw").count() == 2
    store.rewrite("attachments_raw", lambda df: df.withColumn("file_name", F.lit("new")))
    assert not store.append_once("attachments_raw", one, "3")
    assert store.append_once("attachments_raw", one, "4")
    assert sorted(r.file_name for r in store.read("attachments_raw").collect()) == ["f", "new", "new"]


def test_clean_reload_keeps_types(spark, store):
    store.clean_reload("p", spark.createDataFrame([(1, "a")], "n long, s string"))
    again = store.clean_reload("p", spark.createDataFrame([("b", "7")], "s string, n string"))
    assert again.dtypes == [("n", "bigint"), ("s", "string")] and rows(again) == [(7, "b")]
    with pytest.raises(ValueError):
        store.clean_reload("p", spark.range(1))
    assert rows(row_counts({"p": again, "none": again.limit(0)})) == [("none", 0), ("p", 1)]


def test_store_partitioned_refresh(spark, store):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("month"))
    assert rows(store.replace("m", df, partition_by="month").select("id", "month")) == rows(df)


def test_incremental_pick_up(spark, store, tmp_path):
    drops, checkpoint = str(tmp_path / "drops"), str(tmp_path / "check")
    head = "file_name,order_id,document_type,created_date\n"
    write(f"{drops}/1/pdf_manifest.csv", head + "f1,O1,invoice,2024-01-01\nf2,O2,invoice,2024-01-01\n")
    got = ingest_incremental(spark, store, "pdf_manifest", drops, checkpoint, AS_OF)
    assert got.count() == 2
    write(f"{drops}/2/pdf_manifest.csv", head + "f2,O2,credit,2024-01-01\nf3,O3,invoice,2024-01-01\n,O4,invoice,2024-01-01\n")
    for _ in range(2):
        got = ingest_incremental(spark, store, "pdf_manifest", drops, checkpoint, AS_OF)
    assert rows(got.select("file_name", "document_type")) == sorted(
        [("f1", "invoice"), ("f2", "credit"), ("f3", "invoice"), (None, "invoice")], key=repr
    )


def test_loose_files_in_one_call(spark, store, tmp_path):
    write(f"{tmp_path}/a.csv", "id,name\n1,x\n2,y\n")
    write(f"{tmp_path}/b.csv", "id\n7\n")
    files = {"a": f"{tmp_path}/a.csv", "b": f"{tmp_path}/b.csv"}
    assert rows(load_files(store, files)) == rows(load_files(store, files)) == [("a", 2), ("b", 1)]


def test_listed_files_take_no_disk_blocks_and_a_folder_is_listed_piecewise(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "zone")
    wanted = [(f"landing/f{k}.pdf", k) for k in range(1, 1000, 37)] + [("landing/.d/_empty.txt", 0)]
    write_files(spark.createDataFrame(wanted, "path string, length long").repartition(2), root)
    found = landing.relative_to(landing.list_landing(spark, root), root)
    assert rows(found.select("path", "length")) == sorted(wanted)
    assert found.where("modificationTime IS NULL OR modificationTime < current_timestamp() - INTERVAL 1 HOUR").count() == 0
    assert sum(os.stat(f"{root}/{path}").st_blocks for path, _ in wanted) == 0
    monkeypatch.setattr(landing, "_ROWS_PER_BATCH", 10)
    parts = list(landing._list_folders(root)([pd.DataFrame({"path": ["landing", "nowhere"]})]))
    assert [len(p) for p in parts] == [10, 10, 8] and sorted(p for part in parts for p in part["path"]) == sorted(["landing/.d", *[w for w, _ in wanted[:-1]]])


def test_linked_files_take_few_inodes_and_a_listed_zone_any_number_of_folders(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "zone")
    wanted = [(f"landing/f{k}.pdf", k % 3) for k in range(300)]
    twice = [*wanted, ("landing/f0.pdf", 2), ("landing/f7.pdf", 0)]
    write_files(spark.createDataFrame(twice, "path string, length long").coalesce(1), root, linked=True)
    found = landing.relative_to(landing.list_landing(spark, root), root)
    assert rows(found.select("path", "length")) == sorted({**dict(wanted), "landing/f0.pdf": 2, "landing/f7.pdf": 0}.items())
    assert len({os.stat(f"{root}/{path}").st_ino for path, _ in wanted}) <= 5
    # A file that has no room for one more name, or that links cannot reach, is followed by a new one.
    link, calls = os.link, []

    def full(source, target):
        calls.append(target)
        if len(calls) % 4 == 0:
            raise OSError(errno.EMLINK, "too many links")
        link(source, target)

    monkeypatch.setattr(os, "link", full)
    like = None
    for k in range(20):
        like = testbed._put_hole(f"{tmp_path}/h{k}", 5, like)
    assert [os.stat(f"{tmp_path}/h{k}").st_size for k in range(20)] == [5] * 20 and len({os.stat(f"{tmp_path}/h{k}").st_ino for k in range(20)}) == 5


def test_the_listed_documents_are_dealt_over_folders_of_bounded_size(spark, monkeypatch):
    stage = checks.Stage(prepare(spark), "/root/testdata/sf0.001")
    want = rows(stage.landing_documents().unionByName(stage.hidden_documents()).select("path", "length"))
    monkeypatch.setattr(checks, "FILES_PER_FOLDER", 200)
    written, write = [], checks.write_files

    def noted(listing, root, **more):
        written.extend(r.path for r in listing.select("path").collect())
        return write(listing, root, **more)

    monkeypatch.setattr(checks, "write_files", noted)
    assert rows(checks.CHECKS["list_landing"](spark, "/root/testdata/sf0.001")) == want
    sizes = collections.Counter(path.rsplit("/", 1)[0] for path in written)
    assert max(sizes.values()) < 400 < len(want)
