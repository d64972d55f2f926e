"""The registered checks: each operator on the tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from vouchlake import schemas, session
from vouchlake.functions import dates, names, values
from vouchlake.operators import curation, distinct_maps, gate, governance, keys, linking, marts, remediation
from vouchlake.operators.upsert import merge_into_raw, raw_images, replaced_images
from vouchlake.plans.live_marts import LiveMarts
from vouchlake.plans.testbed import AS_OF, LATE_AS_OF, LOADED_AT, STORE, Testbed, replace_files, write_files
from vouchlake.sinks import moves
from vouchlake.sinks.store import TableStore, replayed, row_counts
from vouchlake.sources import csv_drops, landing
from vouchlake.streaming import drops, rewritten

Check = Callable[[SparkSession, str], DataFrame]
CHECKS: dict[str, Check] = {}

# The mapped amounts are exact cents, so sums of them are exact too.
CENTS = 2
# A local file system has room for some ten million names in one folder, and for few more files in all.
FILES_PER_FOLDER = 1_000_000


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that any client compares them alike."""
    temporal = (DateType, TimestampType, TimestampNTZType)
    return df.select(
        [
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, temporal) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Stage(Testbed):
    """The testbed plus the tables the operators derive from it."""

    def store(self, label: str) -> TableStore:
        return TableStore(self.spark, session.scratch_dir(self.spark, label))

    def scratch(self, label: str) -> str:
        return session.scratch_dir(self.spark, label)

    def classified(self) -> DataFrame:
        return linking.classify_documents(self.landing_documents(), self.orders_raw())

    def attachments(self) -> DataFrame:
        return linking.link_attachments(self.classified(), STORE, AS_OF)

    def governed(self) -> DataFrame:
        return governance.governance_status(self.orders_raw(), self.attachments())

    def orders(self) -> DataFrame:
        return curation.curate_orders(self.governed())

    def customers(self) -> DataFrame:
        return curation.curate_customers(self.customers_raw())

    def items(self) -> DataFrame:
        return curation.curate_order_items(self.order_items_raw(), self.orders())

    def returns(self) -> DataFrame:
        return curation.curate_returns(self.returns_raw(), self.orders())

    def recovered(self) -> DataFrame:
        return remediation.recover_late_documents(self.late_documents(), self.error_log())

    def live(self, *tables: str) -> LiveMarts:
        """Live marts over golden tables that reach their rows by inserts, updates and deletes."""
        store = self.store("live")
        marts_of = LiveMarts(store)
        for table in tables:
            final, key, odd = {
                "orders_curated": (self.orders, "order_id", {"order_total": F.lit(1.5), "order_date": F.date_add("order_date", -400), "customer_id": F.lit("C1")}),
                "customers_curated": (self.customers, "customer_id", {}),
                "order_items_curated": (self.items, "order_item_id", {"product_id": F.lit("P1"), "quantity": F.col("quantity") + 3, "order_id": F.lit("O1")}),
                "returns_curated": (self.returns, "return_id", {"order_id": F.lit("O2")}),
            }[table]
            rows, third = store.replace(f"{table}_rows", final()), F.crc32(F.col(key)) % 3
            wrong = rows.where(third == 1).withColumns(odd)
            extra = rows.where(third == 2).withColumns(odd).withColumn(key, F.concat(F.lit("X"), F.col(key)))
            store.insert(table, key, rows.where(third == 2).unionByName(wrong).unionByName(extra))
            marts_of.catch_up()
            batch = rows.where(third != 2)
            store.merge(table, key, batch, lambda held, batch=batch, key=key: replaced_images(held, batch, key))
            store.delete(table, key, extra)
            marts_of.catch_up()
            # Applied; of the golden table the marts read the current rows at most, and nothing reads its source again.
            store.prune(table, 1)
            store.drop(f"{table}_rows")
        return marts_of

    def clv(self) -> DataFrame:
        return marts.customer_clv(self.customers(), self.orders(), CENTS)


def check(build: Callable[[Stage], DataFrame]) -> Callable[[Stage], DataFrame]:
    """Register a check under its function's name."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Stage(session.prepare(spark), sf_dir)))

    CHECKS[build.__name__] = run
    return build


# ---- sources ---------------------------------------------------------------


@check
def scan_csv_fixed(t: Stage) -> DataFrame:
    path = t.scratch("payments-csv")
    t.payments_raw().select(schemas.STAGE["payments"].fieldNames()).write.csv(path, header=True)
    return csv_drops.scan_csv_fixed(t.spark, "payments", path)


@check
def present_tables(t: Stage) -> DataFrame:
    """Row counts of the tables that arrived, three of six here."""
    root = t.scratch("landing")
    for name in ("customers", "orders", "returns"):
        drop = f"{root}/{schemas.LANDING_CSV}/{schemas.STAGE_FILES[name]}"
        getattr(t, f"{name}_stage")().write.csv(drop, header=True)
    listing = landing.relative_to(landing.list_landing(t.spark, f"{root}/{schemas.LANDING_CSV}"), root)
    found = csv_drops.present_tables(listing).collect()
    return row_counts(
        {r["table_name"]: csv_drops.scan_csv_fixed(t.spark, r["table_name"], f"{root}/{r['path']}") for r in found}
    )


@check
def list_landing(t: Stage) -> DataFrame:
    """Every document of the landing zone, those with hidden names among them."""
    root, files = t.scratch("documents"), t.landing_documents().unionByName(t.hidden_documents())
    # One zone beside the other, each with a landing folder that a local file system can hold.
    zones = max(1, -(-files.count() // FILES_PER_FOLDER))
    zone = F.pmod(F.xxhash64("path"), F.lit(zones)).cast("string")
    write_files(files.withColumn("path", F.concat(F.lit("zone-"), zone, F.lit("/"), "path")), root, linked=True)
    found = landing.relative_to(landing.list_landing(t.spark, root), root)
    return found.select(F.regexp_replace("path", "^[^/]+/", "").alias("path"), "length")


@check
def scan_table(t: Stage) -> DataFrame:
    return t.store("scan").replace("orders_curated", t.orders())


@check
def scan_csv_inferred(t: Stage) -> DataFrame:
    path = t.scratch("inferred-csv")
    k = F.col("o_orderkey")
    t.table("orders").select(
        k.alias("order_key"),
        F.col("o_totalprice").alias("price"),
        F.when(k % 3 != 0, F.col("o_custkey")).alias("sparse_number"),
        F.when(k % 2 == 0, "True").otherwise("False").alias("is_even"),
        F.to_date("o_orderdate").alias("ordered"),
        F.col("o_orderpriority").alias("priority"),
    ).write.csv(path, header=True)
    return csv_drops.scan_csv_inferred(t.spark, path)


# ---- sinks -----------------------------------------------------------------


@check
def publish_full_refresh(t: Stage) -> DataFrame:
    """The second refresh replaces the first."""
    store = t.store("refresh")
    store.replace("customers_curated", schemas.conform(t.customers_raw().withColumn("created_date", F.lit(None)), "customers_curated"))
    return store.replace("customers_curated", t.customers())


@check
def append_error_log(t: Stage) -> DataFrame:
    """Two appends, one of them repeated without effect."""
    store = t.store("log")
    store.append_once("data_error_logs", curation.errors_customer_dates(t.customers_raw(), AS_OF), "customers")
    for _ in range(2):
        store.append_once("data_error_logs", curation.errors_payment_dates(t.payments_raw(), AS_OF), "payments")
    return store.read("data_error_logs")


@check
def append_attachments(t: Stage) -> DataFrame:
    store = t.store("attachments")
    store.append_once("attachments_raw", t.attachments(), "link")
    store.append_once("attachments_raw", linking.attachment_rows(t.recovered(), STORE, LATE_AS_OF), "sweep")
    return store.read("attachments_raw")


@check
def clean_reload(t: Stage) -> DataFrame:
    """A reload from text takes the types of the first load."""
    store = t.store("reload")
    first = store.clean_reload("customers_copy", t.customers())
    return store.clean_reload("customers_copy", first.select([F.col(c).cast("string") for c in reversed(first.columns)]))


@check
def plan_csv_archive(t: Stage) -> DataFrame:
    return moves.plan_csv_archive(t.landing_csvs(), datetime(1998, 7, 1))


@check
def plan_pdf_moves(t: Stage) -> DataFrame:
    return moves.plan_document_moves(t.classified())


# ---- row changes -----------------------------------------------------------


@check
def merge_customers(t: Stage) -> DataFrame:
    return merge_into_raw("customers", t.customers_raw(), t.customers_stage(), AS_OF)


@check
def merge_orders_newer_wins(t: Stage) -> DataFrame:
    return merge_into_raw("orders", t.governed(), t.orders_stage(), AS_OF)


@check
def merge_order_items(t: Stage) -> DataFrame:
    return merge_into_raw("order_items", t.order_items_raw(), t.order_items_stage(), AS_OF)


@check
def merge_payments(t: Stage) -> DataFrame:
    return merge_into_raw("payments", t.payments_raw(), t.payments_stage(), AS_OF)


@check
def merge_returns(t: Stage) -> DataFrame:
    return merge_into_raw("returns", t.returns_raw(), t.returns_stage(), AS_OF)


@check
def merge_pdf_manifest(t: Stage) -> DataFrame:
    return merge_into_raw("pdf_manifest", t.pdf_manifest_raw(), t.pdf_manifest_stage(), AS_OF)


@check
def merge_touched_files(t: Stage) -> DataFrame:
    """A merge that replaces the files that hold a key of the batch."""
    store, stage = t.store("touched"), t.payments_stage()
    store.replace("payments_raw", t.payments_raw())
    return store.merge("payments_raw", "payment_id", stage, lambda held: raw_images("payments", held, stage, AS_OF))


@check
def table_changes(t: Stage) -> DataFrame:
    """The change feed of a merge and of a certification."""
    store, stage = t.store("changes"), t.orders_stage()
    store.replace("orders_raw", t.orders_raw())
    proven = store.replace("attachments_raw", t.attachments())
    store.merge("orders_raw", "order_id", stage, lambda held: raw_images("orders", held, stage, AS_OF))
    stale = governance.stale_status(store.read_filed("orders_raw"), proven)
    store.change("orders_raw", "order_id", stale, lambda held: governance.status_images(held, proven))
    return store.changes("orders_raw", 1)


@check
def table_replayed(t: Stage) -> DataFrame:
    """A former version, brought up to date by the change feed."""
    store, stage = t.store("replayed"), t.customers_stage()
    former = store.replace("customers_raw", t.customers_raw())
    store.merge("customers_raw", "customer_id", stage, lambda held: raw_images("customers", held, stage, AS_OF))
    return replayed(former, store.changes("customers_raw", 1))


@check
def governance_status(t: Stage) -> DataFrame:
    return t.governed()


@check
def resolve_error_logs(t: Stage) -> DataFrame:
    return remediation.resolve_error_logs(t.error_log(), t.recovered(), LATE_AS_OF)


@check
def reset_recovered_orders(t: Stage) -> DataFrame:
    return remediation.reset_recovered_orders(t.governed(), t.recovered())


# ---- projections and filters -------------------------------------------------


@check
def project_rename(t: Stage) -> DataFrame:
    return t.customers_raw().select(
        F.col("customer_id").alias("id"),
        F.col("customer_name").alias("name"),
        F.col("country").alias("nation"),
        F.col("created_date").alias("created_text"),
    )


@check
def filter_pass_orders(t: Stage) -> DataFrame:
    return t.governed().filter(F.col("row_status") == schemas.PASS).select("order_id", "customer_id", "row_status")


@check
def filter_landing_suffix(t: Stage) -> DataFrame:
    return landing.filter_documents(t.landing_documents()).select("path")


# ---- joins -------------------------------------------------------------------


@check
def join_inner_customer_orders(t: Stage) -> DataFrame:
    return t.customers().join(t.orders(), "customer_id").select("customer_id", "order_id", "country", "order_total")


@check
def join_returns_items(t: Stage) -> DataFrame:
    """How often each order and product meet in the many-to-many join."""
    return marts.returns_of_items(t.items(), t.returns())


@check
def join_left_sold_returned(t: Stage) -> DataFrame:
    items = t.items()
    sold = items.groupBy("product_id").agg(F.count(F.lit(1)).alias("sold_lines"))
    returned = (
        keys.cascade(items, t.returns(), "order_id").groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    )
    return sold.join(returned, "product_id", "left").select(
        "product_id", "sold_lines", F.coalesce("lines", F.lit(0)).alias("returned_lines")
    )


@check
def join_semi_cascade(t: Stage) -> DataFrame:
    return keys.cascade(t.order_items_raw(), t.orders(), "order_id").select("order_item_id", "order_id", "product_id")


@check
def join_anti_missing(t: Stage) -> DataFrame:
    failed = t.governed().filter(F.col("row_status") == schemas.FAIL)
    logged = curation.open_missing_invoices(t.error_log())
    return keys.without(failed, logged, "order_id", "record_id").select("order_id", "customer_id")


# ---- aggregates ----------------------------------------------------------------


@check
def agg_count(t: Stage) -> DataFrame:
    return t.payments_raw().groupBy("payment_method").agg(
        F.count("payment_date").alias("dated"), F.count(F.lit(1)).alias("payments")
    )


@check
def validate_row_counts(t: Stage) -> DataFrame:
    return row_counts({f"{name}_raw": getattr(t, f"{name}_raw")() for name in schemas.STAGE})


@check
def agg_sum(t: Stage) -> DataFrame:
    revenue = values.money_sum(F.col("quantity") * F.col("unit_price"), CENTS).cast("double")
    return t.items().groupBy("product_id").agg(F.sum("quantity").alias("units"), revenue.alias("revenue"))


@check
def agg_avg(t: Stage) -> DataFrame:
    return t.items().groupBy("product_id").agg(F.avg("quantity").alias("avg_quantity"))


@check
def agg_min_max_date(t: Stage) -> DataFrame:
    return t.orders().groupBy("customer_id").agg(
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")
    )


@check
def agg_count_distinct(t: Stage) -> DataFrame:
    return t.items().groupBy("product_id").agg(F.count_distinct("order_id").alias("orders"))


# ---- scalar functions ------------------------------------------------------------


@check
def fn_regex_date_shape(t: Stage) -> DataFrame:
    return t.payments_raw().select("payment_id", dates.has_date_shape(F.col("payment_date")).alias("has_shape"))


@check
def fn_parse_date(t: Stage) -> DataFrame:
    return t.orders_raw().select("order_id", dates.parse_date(F.col("order_date")).alias("parsed"))


@check
def fn_casts(t: Stage) -> DataFrame:
    return t.orders_raw().select(
        "order_id",
        F.expr("substr(order_id, 2)").cast("bigint").alias("number"),
        F.col("order_total").cast("double").alias("amount"),
        F.col("source_updated_at").cast("timestamp").alias("updated"),
    )


@check
def fn_row_to_json(t: Stage) -> DataFrame:
    raw = t.payments_raw()
    return raw.select("payment_id", values.row_json(raw.columns).alias("raw_data"))


@check
def fn_date_diff(t: Stage) -> DataFrame:
    days = F.date_diff(F.max("order_date"), F.min("order_date")).cast("bigint").alias("days")
    return t.orders().groupBy("customer_id").agg(days)


@check
def fn_extract(t: Stage) -> DataFrame:
    year, month = F.year("order_date").cast("bigint"), F.month("order_date").cast("bigint")
    return t.orders().select("order_id", year.alias("year"), month.alias("month"))


@check
def fn_safe_divide(t: Stage) -> DataFrame:
    ratio = values.safe_divide(F.col("l_quantity").cast("bigint"), F.col("l_partkey") % 4)
    return t._items().select(F.col("item").alias("order_item_id"), ratio.alias("ratio"))


@check
def fn_extract_order_id(t: Stage) -> DataFrame:
    order_id = names.extract_order_id(names.base_name(F.col("path")))
    return t.landing_documents().select("path", order_id.alias("order_id"))


@check
def fn_path_parts(t: Stage) -> DataFrame:
    name = names.base_name(F.col("path"))
    return t.landing_documents().select(
        "path", name.alias("file_name"), names.stem(name).alias("stem"), names.extension(name).alias("extension")
    )


# ---- documents ---------------------------------------------------------------------


@check
def classify_documents(t: Stage) -> DataFrame:
    return t.classified()


@check
def errors_invalid_documents(t: Stage) -> DataFrame:
    return linking.errors_invalid_documents(t.classified(), AS_OF)


@check
def orphan_documents(t: Stage) -> DataFrame:
    return linking.orphan_documents(t.classified(), STORE, AS_OF)


@check
def errors_orphan_documents(t: Stage) -> DataFrame:
    return linking.errors_orphan_documents(t.classified(), AS_OF)


@check
def link_attachments(t: Stage) -> DataFrame:
    return t.attachments()


@check
def recover_late_documents(t: Stage) -> DataFrame:
    return t.recovered()


# ---- golden tables -------------------------------------------------------------------


@check
def curate_customers(t: Stage) -> DataFrame:
    return t.customers()


@check
def curate_orders(t: Stage) -> DataFrame:
    return t.orders()


@check
def curate_order_items(t: Stage) -> DataFrame:
    return t.items()


@check
def curate_payments(t: Stage) -> DataFrame:
    return curation.curate_payments(t.payments_raw(), t.orders())


@check
def curate_returns(t: Stage) -> DataFrame:
    return t.returns()


@check
def curate_attachments(t: Stage) -> DataFrame:
    return curation.curate_attachments(t.attachments(), t.orders())


@check
def curate_pdf_manifest(t: Stage) -> DataFrame:
    return curation.curate_pdf_manifest(t.pdf_manifest_raw())


@check
def errors_customer_dates(t: Stage) -> DataFrame:
    return curation.errors_customer_dates(t.customers_raw(), AS_OF)


@check
def errors_order_dates(t: Stage) -> DataFrame:
    return curation.errors_order_dates(t.governed(), AS_OF)


@check
def errors_missing_invoice(t: Stage) -> DataFrame:
    return curation.errors_missing_invoice(t.governed(), t.error_log(), AS_OF)


@check
def errors_payment_dates(t: Stage) -> DataFrame:
    return curation.errors_payment_dates(t.payments_raw(), AS_OF)


@check
def errors_return_dates(t: Stage) -> DataFrame:
    return curation.errors_return_dates(t.returns_raw(), AS_OF)


@check
def errors_manifest_dates(t: Stage) -> DataFrame:
    return curation.errors_manifest_dates(t.pdf_manifest_raw(), AS_OF)


@check
def gate_customers(t: Stage) -> DataFrame:
    """Golden and log rows of one scan, as the following gates."""
    return gate.gated("customers", t.customers_raw(), AS_OF)


@check
def gate_orders(t: Stage) -> DataFrame:
    return gate.gated("orders", t.governed(), AS_OF, log=t.error_log())


@check
def gate_payments(t: Stage) -> DataFrame:
    return gate.gated("payments", t.payments_raw(), AS_OF, t.orders())


@check
def gate_returns(t: Stage) -> DataFrame:
    return gate.gated("returns", t.returns_raw(), AS_OF, t.orders())


@check
def gate_pdf_manifest(t: Stage) -> DataFrame:
    return gate.gated("pdf_manifest", t.pdf_manifest_raw(), AS_OF)


# ---- marts -----------------------------------------------------------------------------


@check
def customer_clv(t: Stage) -> DataFrame:
    return t.clv()


@check
def customer_segments(t: Stage) -> DataFrame:
    return marts.customer_segments(t.clv())


@check
def monthly_sales(t: Stage) -> DataFrame:
    return marts.monthly_sales(t.orders(), CENTS)


@check
def product_performance(t: Stage) -> DataFrame:
    return marts.product_performance(t.items(), CENTS)


@check
def product_returns(t: Stage) -> DataFrame:
    return marts.product_returns(t.returns(), t.items())


@check
def product_performance_merged(t: Stage) -> DataFrame:
    """The mart from three slices of the items that share orders, each reduced once."""
    store = t.store("distinct")
    items = store.replace("order_items_curated", t.items())
    for k in range(3):
        distinct_maps.add_items(store, items.where(F.crc32("order_item_id") % 3 == k), f"slice-{k}")
    return distinct_maps.product_performance(store.read(distinct_maps.SUMS), store.read(distinct_maps.MAPS))


@check
def live_customer_clv(t: Stage) -> DataFrame:
    return t.live("orders_curated", "customers_curated").customer_clv()


@check
def live_monthly_sales(t: Stage) -> DataFrame:
    return t.live("orders_curated").monthly_sales()


@check
def live_product_performance(t: Stage) -> DataFrame:
    return t.live("order_items_curated").product_performance()


@check
def live_product_returns(t: Stage) -> DataFrame:
    return t.live("order_items_curated", "returns_curated").product_returns()


# ---- streaming ---------------------------------------------------------------------------


@check
def ingest_incremental(t: Stage) -> DataFrame:
    """Two drops picked up one after the other by the same stream."""
    root, store, checkpoint = t.scratch("drops"), t.store("incremental"), t.scratch("checkpoint")
    columns = schemas.STAGE["orders"].fieldNames()
    t.orders_raw().select(columns).write.csv(f"{root}/first", header=True)
    drops.ingest_incremental(t.spark, store, "orders", root, checkpoint, LOADED_AT)
    t.orders_stage().write.csv(f"{root}/second", header=True)
    return drops.ingest_incremental(t.spark, store, "orders", root, checkpoint, AS_OF)


@check
def ingest_rewritten(t: Stage) -> DataFrame:
    """Two drops under the same file names, picked up by the same stream."""
    root, store, checkpoint = t.scratch("rewritten"), t.store("rewritten"), t.scratch("checkpoint")
    columns = schemas.STAGE["orders"].fieldNames()
    for rows, at in ((t.orders_raw().select(columns), LOADED_AT), (t.orders_stage(), AS_OF)):
        replace_files(rows, root, "orders")
        found = rewritten.ingest_rewritten(t.spark, store, "orders", root, checkpoint, at)
    return found
