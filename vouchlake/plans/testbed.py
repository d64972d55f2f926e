"""Raw tables derived from the driver tables, to run the operators on.

Keys, dates and money are computed with whole numbers and text only, so any
SQL engine gives the same rows.
"""

from __future__ import annotations

import contextlib
import errno
import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchlake.session import ship_package
from vouchlake.sinks.moves import file_system

LOADED_AT = datetime(2026, 1, 19)
AS_OF = datetime(2026, 1, 20, 12, 30)
LATE_AS_OF = datetime(2026, 2, 1, 8, 15)
STORE = "store://vault"


def _text(c: Column) -> Column:
    return c.cast("string")


def _decimal_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def day_first(iso: Column) -> Column:
    return F.concat(F.substring(iso, 9, 2), F.lit("-"), F.substring(iso, 6, 2), F.lit("-"), F.substring(iso, 1, 4))


def slashed(iso: Column) -> Column:
    return F.translate(iso, "-", "/")


def compact(iso: Column) -> Column:
    return F.translate(iso, "-", "")


def _stamped(df: DataFrame, source_file: str) -> DataFrame:
    loaded = F.lit(LOADED_AT.isoformat(" ")).cast("timestamp")
    return df.withColumn("ingestion_time", loaded).withColumn("source_file", F.lit(source_file))


class Testbed:
    """The mapped tables of one data folder; every property is lazy."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # -- source rows with the keys the rules speak of ---------------------

    def _orders(self) -> DataFrame:
        day = F.to_date("o_orderdate")
        cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint")
        fiftieth = F.floor(cents / 50).cast("bigint")
        return self.table("orders").select(
            F.col("o_orderkey").alias("k"),
            F.concat(F.lit("C"), F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            day.alias("day"),
            _text(day).alias("iso"),
            F.concat(
                _text(F.floor(fiftieth / 100).cast("bigint")), F.lit("."), F.lpad(_text(fiftieth % 100), 2, "0")
            ).alias("total"),
        )

    def _items(self) -> DataFrame:
        item = F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            (F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("bigint"),
        )
        return self.table("lineitem").withColumn("item", item)

    # -- raw tables -------------------------------------------------------

    def _customers(self) -> DataFrame:
        c = F.col("c_custkey")
        iso = _text(F.date_add(F.lit("2020-01-01").cast("date"), (c % 1000).cast("int")))
        created = (
            F.when(c % 10 <= 5, iso).when(c % 10 <= 7, day_first(iso)).when(c % 10 == 8, slashed(iso))
        )
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.table("customer").join(nation, "c_nationkey").select(
            c.alias("c"),
            F.concat(F.lit("C"), c).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.lit("user"), c, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("555-"), F.lpad(_text(c % 10000), 4, "0")).alias("phone"),
            created.alias("created_date"),
            F.col("n_name").alias("country"),
        )

    def customers_raw(self) -> DataFrame:
        return _stamped(self._customers().drop("c"), "customers.csv")

    def customers_stage(self) -> DataFrame:
        c = F.col("c")
        base = self._customers()
        changed = base.filter(c % 4 == 0).withColumn("email", F.concat(F.lit("new"), c, F.lit("@example.com")))
        added = base.filter(c % 40 == 0).withColumn("customer_id", F.concat(F.lit("C"), c + 10000000))
        return changed.unionByName(added).drop("c")

    def orders_raw(self) -> DataFrame:
        k, iso = F.col("k"), F.col("iso")
        date = F.when(k % 25 == 1, slashed(iso)).when(k % 3 == 0, day_first(iso)).otherwise(iso)
        raw = self._orders().select(
            F.concat(F.lit("O"), k).alias("order_id"),
            "customer_id",
            date.alias("order_date"),
            F.col("status").alias("order_status"),
            F.col("total").alias("order_total"),
            F.concat(_text(F.date_add("day", 1)), F.lit(" 00:00:00")).alias("source_updated_at"),
            F.lit("FAIL").alias("row_status"),
        )
        return _stamped(raw, "orders.csv")

    def orders_stage(self) -> DataFrame:
        k = F.col("k")
        shift = F.when(k % 8 == 0, 5).otherwise(-5)
        base = self._orders().filter(k % 4 == 0)

        def rows(df: DataFrame, key: Column) -> DataFrame:
            return df.select(
                F.concat(F.lit("O"), key).alias("order_id"),
                "customer_id",
                F.col("iso").alias("order_date"),
                F.concat(F.lit("re-"), F.col("status")).alias("order_status"),
                F.col("total").alias("order_total"),
                F.concat(_text(F.date_add("day", shift)), F.lit(" 00:00:00")).alias("source_updated_at"),
            )

        return rows(base, k).unionByName(rows(base.filter(k % 40 == 0), k + 10000000))

    def order_items_raw(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
        raw = self._items().join(part, "l_partkey").select(
            F.col("item").alias("order_item_id"),
            F.concat(F.lit("O"), F.col("l_orderkey")).alias("order_id"),
            F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
            F.col("p_name").alias("product_name"),
            _text(F.col("l_quantity").cast("bigint")).alias("quantity"),
            _decimal_text(F.col("p_retailprice")).alias("unit_price"),
        )
        return _stamped(raw, "order_items.csv")

    def order_items_stage(self) -> DataFrame:
        """Changed quantities, and other order and product ids that a merge
        must not take over; plus new items."""
        k = F.col("l_orderkey")
        base = self._items().filter(k % 4 == 0)

        def rows(df: DataFrame, item: Column) -> DataFrame:
            return df.select(
                item.alias("order_item_id"),
                F.concat(F.lit("O"), k + 1).alias("order_id"),
                F.concat(F.lit("P"), F.col("l_suppkey")).alias("product_id"),
                F.lit("renamed").alias("product_name"),
                _text(F.col("l_quantity").cast("bigint") + 1).alias("quantity"),
                F.lit("9.50").alias("unit_price"),
            )

        added = rows(base.filter(k % 40 == 0), F.concat(F.lit("N"), F.col("item")))
        return rows(base, F.col("item")).unionByName(added)

    def _payments(self) -> DataFrame:
        k = F.col("k")
        iso = _text(F.date_add("day", (k % 5).cast("int")))
        date = F.when(k % 30 == 2, slashed(iso)).when(k % 30 == 3, F.lit(None)).otherwise(iso)
        return self._orders().select(
            k,
            F.concat(F.lit("PAY"), k).alias("payment_id"),
            F.concat(F.lit("O"), k).alias("order_id"),
            date.alias("payment_date"),
            F.when(k % 3 == 0, "card").when(k % 3 == 1, "transfer").otherwise("wallet").alias("payment_method"),
            F.col("total").alias("amount"),
            F.when(k % 7 == 0, "pending").when(k % 7 == 1, "failed").otherwise("settled").alias("payment_status"),
        )

    def payments_raw(self) -> DataFrame:
        return _stamped(self._payments().drop("k"), "payments.csv")

    def payments_stage(self) -> DataFrame:
        k = F.col("k")
        base = self._payments()
        changed = base.filter(k % 4 == 0).withColumn("payment_status", F.lit("refunded"))
        added = base.filter(k % 40 == 0).withColumn("payment_id", F.concat(F.lit("PAY"), k + 10000000))
        return changed.unionByName(added).drop("k")

    def _returns(self) -> DataFrame:
        iso = _text(F.date_add(F.to_date("l_shipdate"), 7))
        s = F.col("l_suppkey") % 4
        reason = F.when(s == 0, "damaged").when(s == 1, "late").when(s == 2, "wrong item").otherwise("unwanted")
        return self._items().filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("k"),
            F.concat(F.lit("R"), F.col("item")).alias("return_id"),
            F.concat(F.lit("O"), F.col("l_orderkey")).alias("order_id"),
            F.when(F.col("l_partkey") % 20 == 4, slashed(iso)).otherwise(iso).alias("return_date"),
            reason.alias("reason"),
            _decimal_text(F.col("l_extendedprice")).alias("refund_amount"),
        )

    def returns_raw(self) -> DataFrame:
        return _stamped(self._returns().drop("k"), "returns.csv")

    def returns_stage(self) -> DataFrame:
        k = F.col("k")
        base = self._returns()
        changed = base.filter(k % 4 == 0).withColumn("reason", F.lit("reviewed"))
        added = base.filter(k % 40 == 0).withColumn("return_id", F.concat(F.lit("N"), F.col("return_id")))
        return changed.unionByName(added).drop("k")

    def _manifest(self) -> DataFrame:
        k, iso = F.col("k"), F.col("iso")
        return self._orders().select(
            k,
            self._invoice(k, iso).alias("file_name"),
            F.concat(F.lit("O"), k).alias("order_id"),
            F.lit("invoice").alias("document_type"),
            F.when(k % 15 == 6, slashed(iso)).otherwise(iso).alias("created_date"),
        )

    def pdf_manifest_raw(self) -> DataFrame:
        return _stamped(self._manifest().drop("k"), "pdf_manifest.csv")

    def pdf_manifest_stage(self) -> DataFrame:
        k = F.col("k")
        base = self._manifest()
        changed = base.filter(k % 4 == 0).withColumn("document_type", F.lit("credit note"))
        added = base.filter(k % 40 == 0).withColumn("file_name", F.concat(F.lit("copy_"), F.col("file_name")))
        return changed.unionByName(added).drop("k")

    # -- error log ------------------------------------------------------------

    def error_log(self) -> DataFrame:
        """Log rows of orders without a document: open, closed, other kinds."""
        kind = F.floor(F.col("k") / 10).cast("bigint") % 5
        loaded = F.lit(LOADED_AT.isoformat(" ")).cast("timestamp")
        message = F.when(kind == 2, "Invalid order_date format").otherwise("Missing Invoice PDF")
        return self._orders().filter((F.col("k") % 10 == 0) & (kind != 3)).select(
            F.concat(F.lit("O"), F.col("k")).alias("record_id"),
            F.lit("orders_raw").alias("source_table"),
            message.alias("error_message"),
            F.lit("{}").alias("raw_data"),
            F.lit(0).cast("bigint").alias("retry_count"),
            loaded.alias("created_at"),
            (kind == 1).alias("resolved_flag"),
            F.when(kind == 1, loaded).alias("resolved_at"),
        )

    # -- landing documents --------------------------------------------------

    @staticmethod
    def _invoice(key: Column, iso: Column, suffix: str = ".pdf") -> Column:
        return F.concat(F.lit("invoice_O"), key, F.lit("_"), compact(iso), F.lit(suffix))

    def _listing(self, names: Column) -> DataFrame:
        # Sizes and times follow from the order, as a listing would carry them.
        return self._orders().select("k", "day", F.explode(names).alias("name")).select(
            F.concat(F.lit("landing/unstructured/"), F.col("name")).alias("path"),
            F.col("day").cast("timestamp").alias("modificationTime"),
            (F.col("k") % 1000).alias("length"),
        )

    def landing_documents(self) -> DataFrame:
        """First wave: named well, misnamed, double, orphaned and other files."""
        k, iso = F.col("k"), F.col("iso")
        main = (
            F.when(k % 10 == 0, F.lit(None))
            .when(k % 50 == 7, F.concat(F.lit("inv-"), k, F.lit(".pdf")))
            .when(k % 50 == 9, self._invoice(k, iso, ".PDF"))
            .otherwise(self._invoice(k, iso))
        )
        second = F.when(k % 50 == 11, self._invoice(k, _text(F.date_add("day", 1))))
        orphan = F.when(k % 100 == 3, self._invoice(k + 20000000, iso))
        other = F.when(k % 100 == 4, F.concat(F.lit("readme_"), k, F.lit(".txt")))
        return self._listing(F.array_compact(F.array(main, second, orphan, other)))

    def late_documents(self) -> DataFrame:
        """Second wave: missing documents, and some for orders not open."""
        k, iso = F.col("k"), F.col("iso")
        late = F.when((k % 20 == 10) | (k % 100 == 5), self._invoice(k, iso))
        return self._listing(F.array_compact(F.array(late)))

    def hidden_documents(self) -> DataFrame:
        """Files, some in folders, whose names begin with an underscore or a dot."""
        k = F.col("k")
        names = [F.concat(F.lit(start), k, F.lit(end)) for start, end in (("_draft_", ".pdf"), (".part_", ".pdf"), ("_held/.d/", ".txt"))]
        return self._listing(F.array_compact(F.array(*[F.when(k % 250 == n, name) for n, name in enumerate(names)])))

    def landing_csvs(self) -> DataFrame:
        """CSV drops and their marker files, one pair per order."""
        drop = F.concat(F.lit("landing/structured/orders.v"), F.col("k"))
        return self._orders().select(
            F.explode(F.array(F.concat(drop, F.lit(".csv")), F.concat(drop, F.lit(".csv.done")))).alias("path"),
            (F.col("day").cast("timestamp") + F.make_dt_interval(secs=F.col("k"))).alias("modificationTime"),
            F.lit(1).cast("bigint").alias("length"),
        )


def _put_hole(target: str, length: int, like: str | None) -> str:
    """A local file of this length, as another name of the file ``like`` if that can have one more.

    Returns the file that the next one of this length may be another name of.
    """
    while True:
        try:
            if like is not None:
                os.link(like, target)
                if os.stat(target).st_size == length:
                    return like
                # Another row had the path of ``like``, and another length.
                os.unlink(target)
                like = None
            with open(target, "xb") as out:
                out.truncate(length)
            return target
        except FileExistsError:
            # Not written over: the file may have other names.
            with contextlib.suppress(FileNotFoundError):
                os.unlink(target)
        except OSError as error:
            # Names used up, no links here, or the file was replaced meanwhile.
            if like is None or error.errno not in (errno.EMLINK, errno.EPERM, errno.ENOTSUP, errno.ENOENT):
                raise
            like = None


def write_files(listing: DataFrame, root: str, linked: bool = False) -> int:
    """Create the listed files below a root folder, in the tasks.

    Only names and sizes matter, so local files are holes of the listed size:
    millions of small ones take no blocks of the disk. With ``linked`` those of
    one length are names of a few files, and take no inodes either; for files
    that nobody writes to.
    """
    ship_package(listing.sparkSession)

    def create(batches):
        store, base = file_system(root)
        made, holes = set(), {}
        for batch in batches:
            for path, length in zip(batch["path"], batch["length"]):
                target = f"{base}/{path}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                if store.type_name == "local" and linked:
                    holes[length] = _put_hole(target, int(length), holes.get(length))
                    continue
                if store.type_name == "local":
                    with open(target, "wb") as out:
                        out.truncate(int(length))
                    continue
                with store.open_output_stream(target) as out:
                    out.write(b"x" * int(length))
            yield batch[["length"]]

    return listing.select("path", "length").mapInPandas(create, "length bigint").count()


def replace_files(rows: DataFrame, root: str, name: str) -> None:
    """CSV files ``<name>-<n>.csv`` below a root folder, over those that are there."""
    incoming = f"{root}/_{name}"
    rows.write.mode("overwrite").csv(incoming, header=True)
    jvm, conf = rows.sparkSession.sparkContext._jvm, rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(conf)
    parts = sorted(status.getPath().toString() for status in files.listStatus(path(incoming)) if status.getPath().getName().endswith(".csv"))
    for n, part in enumerate(parts):
        target = path(f"{root}/{name}-{n}.csv")
        files.delete(target, False)
        files.rename(path(part), target)
    files.delete(path(incoming), True)
