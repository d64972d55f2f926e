"""The whole flow over stored tables and a store of landing files.

Each step reads written tables and writes new ones, so no step depends on the
lineage of another, and a step repeated under the same run id picks up where
it stopped: document plans are written before they are acted on, appends are
named after the run, and files move only after the rows about them are stored.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.operators import curation, gate, governance, linking, marts, remediation
from vouchlake.operators.upsert import raw_images
from vouchlake.sinks.moves import (
    apply_moves,
    plan_csv_archive,
    plan_document_moves,
    require_distinct_destinations,
    require_moved,
)
from vouchlake.sinks.store import TableStore, row_counts
from vouchlake.sources.csv_drops import present_tables, scan_csv_fixed
from vouchlake.sources.landing import list_landing, relative_to


@dataclass
class Workspace:
    """Where a deployment keeps its files and tables.

    ``files_root`` is the object store as Spark reaches it. ``store_uri`` is
    the address written into stored paths, the same unless stated.
    ``inventory`` gives the listing of a zone as a DataFrame, paths relative to
    the root. Without it tasks list the zone, a folder each; a zone of very
    many files in one folder should bring the store's own inventory table. A
    finished run leaves ``keep_versions`` versions of each table.

    ``log_missing_dates`` logs rows without a date, ``only_new_errors`` leaves
    out what is still open in the log, ``close_open_logs`` closes the
    missing-invoice rows of orders that an ordinary run certifies.
    """

    spark: SparkSession
    files_root: str
    tables: TableStore
    store_uri: str = ""
    on_bad_date: str = "fail"
    money_scale: int | None = None
    inventory: Callable[[str], DataFrame] | None = None
    keep_versions: int = 3
    log_missing_dates: bool = False
    only_new_errors: bool = False
    close_open_logs: bool = False

    def listing(self, zone: str) -> DataFrame:
        if self.inventory is not None:
            return self.inventory(zone)
        return relative_to(list_landing(self.spark, f"{self.files_root}/{zone}"), self.files_root)

    @property
    def uri(self) -> str:
        return self.store_uri or self.files_root


def _together(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Submit independent jobs at once; Spark shares the executors out."""
    own = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for done in [pool.submit(own(step)) for step in steps]:
            done.result()


def ingest_and_link(ws: Workspace, run_time: datetime, run_id: str) -> list[str]:
    """Merge the landing CSVs that are there, then link the documents."""
    tables = ws.tables
    # Planned before the merges, so every file in it was there to be merged. A
    # run that is repeated keeps the plan: what came since stays for the next.
    files = ws.listing(schemas.LANDING_CSV)
    archive = _plan_once(ws, "csv_archive_plan", run_id, lambda: plan_csv_archive(files, run_time, with_time=True))
    # At most one row per table of the fixed list.
    present = sorted(row["table_name"] for row in present_tables(files).collect())

    def load(table: str) -> None:
        raw, token = f"{table}_raw", f"{run_id}-merge"
        if tables.has_token(raw, token):
            return
        path = f"{ws.files_root}/{schemas.LANDING_CSV}/{schemas.STAGE_FILES[table]}"
        stage = tables.replace(f"{table}_stage", scan_csv_fixed(ws.spark, table, path))
        tables.merge(raw, schemas.KEYS[table], stage, lambda rows: raw_images(table, rows, stage, run_time), token)

    if present:
        _together(ws.spark, *[lambda t=table: load(t) for table in present])
    require_moved(apply_moves(archive, ws.files_root))
    link_documents(ws, run_time, run_id)
    return present


def _plan_once(ws: Workspace, table: str, run_id: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A written plan of this run: made once, read again if the run repeats."""
    if not ws.tables.has_token(table, run_id):
        # Listing tasks yield few rows each; rebalancing writes them together.
        ws.tables.replace(table, build().hint("rebalance"), token=run_id)
    return ws.tables.read(table)


def link_documents(ws: Workspace, run_time: datetime, run_id: str) -> None:
    tables = ws.tables
    found = _plan_once(
        ws,
        "landing_documents",
        run_id,
        lambda: linking.classify_documents(ws.listing(schemas.LANDING_PDF), tables.read("orders_raw")),
    )
    plan = plan_document_moves(found)
    require_distinct_destinations(plan)
    batch = f"{run_id}-link"
    _together(
        ws.spark,
        lambda: tables.append_once("attachments_raw", linking.link_attachments(found, ws.uri, run_time), batch),
        lambda: tables.append_once("orphan_pdfs", linking.orphan_documents(found, ws.uri, run_time), batch),
        lambda: tables.append_once("data_error_logs", linking.document_errors(found, run_time), batch),
    )
    require_moved(apply_moves(plan, ws.files_root, checked=True))


def certify(ws: Workspace) -> None:
    """Set the status of the orders that gained or lost their document; other files stay as they are."""
    proven = ws.tables.read("attachments_raw")
    stale = governance.stale_status(ws.tables.read_filed("orders_raw"), proven)
    ws.tables.change("orders_raw", "order_id", stale, lambda rows: governance.status_images(rows, proven))


def curate(ws: Workspace, run_time: datetime, run_id: str) -> None:
    """Rebuild the golden tables and log what they leave out, each raw table in one scan."""
    t = ws.tables

    def through(table: str, orders: DataFrame | None = None, month_of: str | None = None) -> None:
        rows = gate.gated(table, t.read(f"{table}_raw"), run_time, orders, t.read("data_error_logs"), ws.on_bad_date, ws.log_missing_dates)
        t.replace_gated(f"{table}_curated", rows, month_of)

    _together(ws.spark, lambda: through("customers"), lambda: through("orders", month_of="order_date"))
    orders = t.read("orders_curated")
    _together(
        ws.spark,
        lambda: t.replace("order_items_curated", curation.curate_order_items(t.read("order_items_raw"), orders)),
        lambda: through("payments", orders, "payment_date"),
        lambda: through("returns", orders, "return_date"),
        lambda: t.replace("attachments_curated", curation.curate_attachments(t.read("attachments_raw"), orders)),
        lambda: through("pdf_manifest"),
    )
    t.append_once("data_error_logs", curation_errors(ws), f"{run_id}-curate")


def curation_errors(ws: Workspace) -> DataFrame:
    """What the gates of the current golden tables rejected."""
    t = ws.tables
    parts = [t.rejected(f"{table}_curated") for table in gate.RULES]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return curation.only_new_errors(union, t.read("data_error_logs")) if ws.only_new_errors else union


def build_marts(ws: Workspace) -> None:
    t, scale = ws.tables, ws.money_scale

    def customers() -> None:
        clv = t.replace(
            "customer_clv", marts.customer_clv(t.read("customers_curated"), t.read("orders_curated"), scale)
        )
        t.replace("customer_segments", marts.customer_segments(clv))

    items = t.read("order_items_curated")
    _together(
        ws.spark,
        customers,
        lambda: t.replace("monthly_sales", marts.monthly_sales(t.read("orders_curated"), scale)),
        lambda: t.replace("product_performance", marts.product_performance(items, scale)),
        lambda: t.replace("product_returns", marts.product_returns(t.read("returns_curated"), items)),
    )


def sweep_late_documents(ws: Workspace, run_time: datetime, run_id: str) -> None:
    """Attach late documents to orders logged as missing one."""
    t = ws.tables
    found = _plan_once(
        ws,
        "late_documents",
        run_id,
        lambda: remediation.recover_late_documents(ws.listing(schemas.LANDING_PDF), t.read("data_error_logs")),
    )
    if found.isEmpty():
        return
    plan = plan_document_moves(found)
    require_distinct_destinations(plan)
    t.append_once("attachments_raw", linking.attachment_rows(found, ws.uri, run_time), f"{run_id}-sweep")
    t.rewrite("data_error_logs", lambda log: remediation.resolve_error_logs(log, found, run_time))
    # The orders' status follows from their attachments when the run certifies.
    require_moved(apply_moves(plan, ws.files_root, checked=True), tolerated=("missing",))


def certified_run(ws: Workspace, run_time: datetime, run_id: str) -> None:
    """Ingest, certify, curate and build the marts."""
    ingest_and_link(ws, run_time, run_id)
    _refresh(ws, run_time, f"{run_id}-certified")


def remediation_run(ws: Workspace, run_time: datetime, run_id: str) -> None:
    """Recover late documents and bring everything behind them up to date."""
    sweep_late_documents(ws, run_time, run_id)
    _refresh(ws, run_time, f"{run_id}-remediation")


def _refresh(ws: Workspace, run_time: datetime, run_name: str) -> None:
    certify(ws)
    curate(ws, run_time, run_name)
    if ws.close_open_logs:
        proven = ws.tables.read("attachments_raw")
        ws.tables.rewrite("data_error_logs", lambda log: remediation.resolve_error_logs(log, proven, run_time))
    build_marts(ws)
    # Only now, as a run that has to be repeated looks for its own versions.
    for table in (*schemas.KNOWN, "csv_archive_plan", "landing_documents", "late_documents"):
        ws.tables.prune(table, ws.keep_versions)
    for table in ("attachments_raw", "orphan_pdfs", "data_error_logs"):
        ws.tables.compact(table, keep=run_name)


def summary(ws: Workspace) -> DataFrame:
    """Rows of every stored table."""
    return row_counts({name: ws.tables.read(name) for name in schemas.TABLES}).orderBy(F.col("table_name"))
