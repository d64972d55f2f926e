"""Times the operators on stored tables and prints one JSON line.

``$BENCH_SF_DIR`` names the data folder, ``$BENCH_CPUS`` the local cores. The
raw tables are written to Parquet first, outside the timings. Each operator
runs once to warm up, then three times; the median counts. Results go to the
``noop`` sink, so every row is computed and none is stored. The operators with
joins run a second time without broadcasts, as ``<name>_shuffled``, which is
the plan a large table gets. ``rewrite_log`` and ``stream_merge`` are sinks,
run once each; ``end_to_end`` is one run over landing files, from ingest to the
marts after late documents. ``value`` is the sum of the first group.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime, timedelta, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vouchlake import schemas, session
from vouchlake.operators import curation, governance, linking, marts, remediation
from vouchlake.operators.upsert import merge_into_raw
from vouchlake.plans import certification
from vouchlake.plans.testbed import AS_OF, STORE, Testbed, write_files
from vouchlake.sinks.store import TableStore
from vouchlake.streaming.drops import ingest_incremental

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
NO_JOIN = {"curate_customers", "curate_orders", "errors_payment_dates", "monthly_sales", "product_performance"}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(build) -> float:
    run(build())
    seconds = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run(build())
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def stored_inputs(spark, bed: Testbed, store: TableStore) -> None:
    # Several files per table, as any table of size has; one file, one task.
    files = int(CPUS)
    for table in schemas.STAGE:
        store.replace(f"{table}_raw", getattr(bed, f"{table}_raw")().repartition(files))
        store.replace(f"{table}_stage", getattr(bed, f"{table}_stage")().repartition(files))
    store.replace("listing", bed.landing_documents().repartition(files))
    store.replace("late_listing", bed.late_documents().repartition(files))
    found = linking.classify_documents(store.read("listing"), store.read("orders_raw"))
    store.replace("attachments_raw", linking.link_attachments(found, STORE, AS_OF))
    governed = governance.governance_status(store.read("orders_raw"), store.read("attachments_raw"))
    orders = store.replace("orders_curated", curation.curate_orders(store.replace("orders_governed", governed)))
    store.replace("customers_curated", curation.curate_customers(store.read("customers_raw")))
    store.replace("order_items_curated", curation.curate_order_items(store.read("order_items_raw"), orders))
    store.replace("returns_curated", curation.curate_returns(store.read("returns_raw"), orders))
    store.replace(
        "data_error_logs",
        curation.errors_missing_invoice(
            store.read("orders_governed"), schemas.empty(spark, "data_error_logs"), AS_OF
        ),
    )


def more_merges(store: TableStore) -> dict:
    tables = ("customers", "payments", "returns", "pdf_manifest")
    return {
        f"merge_{t}": lambda t=t: merge_into_raw(t, store.read(f"{t}_raw"), store.read(f"{t}_stage"), AS_OF) for t in tables
    }


def without_broadcast(spark, builds: dict) -> dict:
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    seconds = {f"{name}_shuffled": round(timed(build), 4) for name, build in builds.items()}
    spark.conf.set(THRESHOLD, before)
    return seconds


def sinks(spark, store: TableStore) -> dict:
    store.append_once("bench_log", store.read("data_error_logs"), "first")
    late = remediation.recover_late_documents(store.read("late_listing"), store.read("data_error_logs"))
    start = time.perf_counter()
    store.rewrite("bench_log", lambda log: remediation.resolve_error_logs(log, late, AS_OF))
    rewritten = time.perf_counter()
    drop = session.scratch_dir(spark, "bench-drops")
    store.read("payments_stage").repartition(8).write.csv(f"{drop}/one", header=True)
    begun = time.perf_counter()
    ingest_incremental(spark, store, "payments", drop, session.scratch_dir(spark, "bench-checkpoint"), AS_OF)
    return {"rewrite_log": round(rewritten - start, 4), "stream_merge": round(time.perf_counter() - begun, 4)}


def operators(store: TableStore) -> dict:
    read = store.read
    return {
        "classify_documents": lambda: linking.classify_documents(read("listing"), read("orders_raw")),
        "governance_status": lambda: governance.governance_status(read("orders_raw"), read("attachments_raw")),
        "merge_orders_newer_wins": lambda: merge_into_raw(
            "orders", read("orders_governed"), read("orders_stage"), AS_OF
        ),
        "merge_order_items": lambda: merge_into_raw(
            "order_items", read("order_items_raw"), read("order_items_stage"), AS_OF
        ),
        "curate_customers": lambda: curation.curate_customers(read("customers_raw")),
        "curate_orders": lambda: curation.curate_orders(read("orders_governed")),
        "curate_order_items": lambda: curation.curate_order_items(read("order_items_raw"), read("orders_curated")),
        "curate_payments": lambda: curation.curate_payments(read("payments_raw"), read("orders_curated")),
        "curate_returns": lambda: curation.curate_returns(read("returns_raw"), read("orders_curated")),
        "errors_payment_dates": lambda: curation.errors_payment_dates(read("payments_raw"), AS_OF),
        "errors_missing_invoice": lambda: curation.errors_missing_invoice(
            read("orders_governed"), read("data_error_logs"), AS_OF
        ),
        "recover_late_documents": lambda: remediation.recover_late_documents(
            read("late_listing"), read("data_error_logs")
        ),
        "customer_clv": lambda: marts.customer_clv(read("customers_curated"), read("orders_curated")),
        "monthly_sales": lambda: marts.monthly_sales(read("orders_curated")),
        "product_performance": lambda: marts.product_performance(read("order_items_curated")),
        "product_returns": lambda: marts.product_returns(read("returns_curated"), read("order_items_curated")),
    }


def end_to_end(spark, bed: Testbed) -> float:
    root = session.scratch_dir(spark, "bench-files")
    for table in schemas.STAGE:
        drop = f"{root}/{schemas.LANDING_CSV}/{schemas.STAGE_FILES[table]}"
        getattr(bed, f"{table}_raw")().select(schemas.STAGE[table].fieldNames()).write.csv(drop, header=True)
    write_files(bed.landing_documents(), root)
    ws = certification.Workspace(spark, root, TableStore(spark, session.scratch_dir(spark, "bench-flow")))
    now = datetime.now(timezone.utc) + timedelta(hours=1)
    start = time.perf_counter()
    certification.certified_run(ws, now, "wave1")
    first = time.perf_counter() - start
    write_files(bed.late_documents(), root)
    start = time.perf_counter()
    certification.remediation_run(ws, now, "wave2")
    return first + time.perf_counter() - start


def main() -> None:
    spark = session.local_session(CPUS, "bench", shuffle_partitions=int(CPUS))
    bed = Testbed(spark, SF_DIR)
    store = TableStore(spark, session.scratch_dir(spark, "bench"))
    stored_inputs(spark, bed, store)
    seconds = {name: round(timed(build), 4) for name, build in operators(store).items()}
    total = round(sum(seconds.values()), 4)
    extra = more_merges(store)
    seconds |= {name: round(timed(build), 4) for name, build in extra.items()}
    joined = {name: build for name, build in (operators(store) | extra).items() if name not in NO_JOIN}
    seconds |= without_broadcast(spark, joined)
    seconds |= sinks(spark, store)
    if os.environ.get("BENCH_END_TO_END", "1") == "1":
        seconds["end_to_end"] = round(end_to_end(spark, bed), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of operator medians",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
