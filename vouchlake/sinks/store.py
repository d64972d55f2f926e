"""Parquet tables in version folders.

``<root>/<table>/v<number>[-<token>]/`` holds one full state of a table. A
version counts once Spark's job commit has put ``_SUCCESS`` into it, so a
refresh that fails leaves the former state readable and a table may be
rebuilt from itself. Rows of an append go to ``batch=<name>`` below the
current version, moved there in one rename, and a batch that is already there
is not written again: repeating a run after a lost driver adds nothing twice.
Tokens of versions that are deleted stay behind as empty files in ``_tokens``.

A version made by ``merge``, ``change`` or ``insert`` holds new files only. Its
``manifest`` lists all files of the table, most of them in the folders of
earlier versions, with their rows and the least and greatest key; the files a
change does not touch are listed again and not written. Beside the new rows
stand the images of the rows that changed: the change feed of that version.
The driver sees the list of files, as it does whenever Spark reads a table,
and never keys or rows.

One writer per table at a time is assumed; readers need no coordination.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vouchlake import schemas
from vouchlake.session import shuffles_given_back

BATCH = "batch"
MONTH = "month_of"
FILE = "__file"
ROWS_PER_FILE = 1_000_000
IMAGES = ("insert", "before", "after", "delete")
_VERSION = re.compile(r"^v(\d{8})(?:-(.*))?$")
_MANIFEST, _ABOUT, _FILES = "manifest", "about.json", "files"
_GOLDEN, _LOG = "tag=golden", "tag=log"
_ENTRIES = "path string, rows long, low string, high string"


def _safe(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
        raise ValueError(f"not usable in a folder name: {name!r}")
    return name


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- folders ---------------------------------------------------------

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def _versions(self, table: str) -> list[tuple[int, str, str]]:
        """(number, token, folder) of the complete versions, oldest first."""
        folder = f"{self.root}/{_safe(table)}"
        if not self._exists(folder):
            return []
        found = []
        for status in self._fs.listStatus(self._path(folder)):
            name = status.getPath().getName()
            match = _VERSION.match(name)
            if match and self._exists(f"{folder}/{name}/_SUCCESS"):
                found.append((int(match[1]), match[2] or "", f"{folder}/{name}"))
        return sorted(found)

    def _next_folder(self, table: str, token: str | None) -> str:
        versions = self._versions(table)
        number = versions[-1][0] + 1 if versions else 1
        suffix = f"-{_safe(token)}" if token else ""
        return f"{self.root}/{_safe(table)}/v{number:08d}{suffix}"

    # -- reading ---------------------------------------------------------

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def has_token(self, table: str, token: str) -> bool:
        """Whether a version with this token was ever complete, be it pruned since or not."""
        if any(seen == token for _, seen, _ in self._versions(table)):
            return True
        return self._exists(self._token_file(table, token))

    def _token_file(self, table: str, token: str) -> str:
        return f"{self.root}/{_safe(table)}/_tokens/{_safe(token)}"

    def _mark(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def location(self, table: str, version: int | None = None) -> str:
        found = [folder for number, _, folder in self._versions(table) if version in (None, number)]
        if not found:
            raise FileNotFoundError(f"no complete version of table {table}" if version is None else f"no version {version} of table {table}")
        return found[-1]

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The current rows, or those of an earlier version; a known table never written yet reads as empty."""
        if table in schemas.TABLES and not self.exists(table):
            return schemas.empty(self.spark, table)
        reader = self.spark.read
        if table in schemas.KNOWN:
            # Saves the job that would look the types up in a file.
            reader = reader.schema(schemas.KNOWN[table])
        folder = self.location(table, version)
        if not self._exists(f"{folder}/{_MANIFEST}"):
            return reader.parquet(self._golden(folder)).drop(BATCH, MONTH)
        return self._rows_of(table, [row["path"] for row in self._manifest(folder).collect()])

    def read_months(self, table: str, first: str, last: str) -> DataFrame:
        """The rows of the months from ``first`` to ``last`` (``yyyy-MM``); other folders are not read."""
        df = self.spark.read.schema(StructType(list(self._type(table).fields)).add(MONTH, "string")).parquet(self._golden(self.location(table)))
        return df.where(F.col(MONTH).cast("string").between(first, last)).drop(BATCH, MONTH)

    # -- writing ---------------------------------------------------------

    def replace(
        self,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        token: str | None = None,
        month_of: str | None = None,
    ) -> DataFrame:
        """Full refresh: write a new version, which readers then see whole.

        ``partition_by`` lays the files out by a column of few values; the
        rebalance hint lets Spark split a value that holds much of the data
        into several files and merge small ones. ``month_of`` lays them out by
        the month of a date, in a column that readers do not see.
        """
        folder = self._next_folder(table, token)
        if month_of:
            df, partition_by = df.withColumn(MONTH, F.date_format(month_of, "yyyy-MM")), MONTH
        writer = df
        if partition_by:
            writer = df.hint("rebalance", partition_by)
        writer = writer.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with shuffles_given_back(self.spark):
            writer.parquet(folder)
        return self.read(table)

    def _golden(self, folder: str) -> str:
        """Where the rows of a version are: beside log rows in one written by ``replace_gated``."""
        return f"{folder}/{_GOLDEN}" if self._exists(f"{folder}/{_GOLDEN}") or self._exists(f"{folder}/{_LOG}") else folder

    def replace_gated(self, table: str, rows: DataFrame, month_of: str | None = None) -> DataFrame:
        """Full refresh from rows that carry a ``tag``: golden ones are the table, log ones its ``rejected``.

        Both kinds are written by one job.
        """
        folder, by = self._next_folder(table, None), ["tag"]
        if month_of:
            rows, by = rows.withColumn(MONTH, F.date_format(month_of, "yyyy-MM")), ["tag", MONTH]
        rows.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(folder)
        if not self._exists(f"{folder}/{_GOLDEN}"):
            self._fs.mkdirs(self._path(f"{folder}/{_GOLDEN}"))
        return self.read(table)

    def rejected(self, table: str) -> DataFrame:
        """The log rows of the current version."""
        kind = schemas.CURATED["data_error_logs"]
        folder = f"{self.location(table)}/{_LOG}"
        if not self._exists(folder):
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(folder).select(kind.fieldNames())

    def append_once(self, table: str, df: DataFrame, batch: str) -> bool:
        """Add rows under a batch name; False when that batch is there already."""
        if self.exists(table):
            folder = self.location(table)
            if self._exists(f"{folder}/{_MANIFEST}"):
                raise ValueError(f"{table} is kept by files; add rows with insert")
        else:
            folder = self._next_folder(table, None)
        final = f"{folder}/{BATCH}=b-{_safe(batch)}"
        added = not (self._exists(final) or self._exists(self._token_file(table, f"batch-{batch}")))
        if added:
            incoming = f"{folder}/_incoming-{batch}"
            df.write.mode("overwrite").parquet(incoming)
            self._rename(incoming, final)
        # Also for a batch found: its writer may have died before this line.
        if not self._exists(f"{folder}/_SUCCESS"):
            self._mark(f"{folder}/_SUCCESS")
        return added

    def rewrite(self, table: str, change) -> DataFrame:
        """Replace an appended table by ``change(rows)``, batches kept.

        ``change`` must pass every column through, the batch column with them.
        """
        if not self.exists(table):
            return self.read(table)
        if self._exists(f"{self.location(table)}/{_MANIFEST}"):
            return self.replace(table, change(self.read(table)))
        rows = self.spark.read.parquet(self.location(table))
        batched = BATCH in rows.columns
        return self.replace(table, change(rows), partition_by=BATCH if batched else None)

    def clean_reload(self, table: str, df: DataFrame) -> DataFrame:
        """Empty the table and load it again under the types it already has.

        The first load fixes names and types. A later load must bring the same
        columns and text or numbers that cast to their types, else it fails.
        """
        if self.exists(table):
            types = self.read(table).schema
            if set(types.fieldNames()) != set(df.columns):
                raise ValueError(f"columns of {table} are {types.fieldNames()}, not {df.columns}")
            df = df.select([F.col(f"`{t.name}`").cast(t.dataType).alias(t.name) for t in types])
        return self.replace(table, df)

    # -- changes by file -------------------------------------------------

    def _about(self, folder: str) -> dict:
        """What a version made by files says about itself; empty for one written whole."""
        path = f"{folder}/{_ABOUT}"
        if not self._exists(path):
            return {}
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _manifest(self, folder: str) -> DataFrame:
        return self.spark.read.schema(_ENTRIES).parquet(f"{folder}/{_MANIFEST}")

    def _type(self, table: str) -> StructType:
        if table in schemas.KNOWN:
            return schemas.KNOWN[table]
        about = self._about(self.location(table))
        return StructType.fromJson(about["schema"]) if about else self.read(table).schema

    def _rows_of(self, table: str, paths: Iterable[str]) -> DataFrame:
        """The rows of some files of a table, given by their paths below it."""
        paths = [f"{self.root}/{table}/{path}" for path in paths]
        if not paths:
            return self.spark.createDataFrame([], self._type(table))
        return self.spark.read.schema(self._type(table)).parquet(*paths)

    def _filed(self, table: str, rows: DataFrame) -> DataFrame:
        """The rows with the file they come from, as a path below the table."""
        path = F.regexp_extract(F.col("_metadata.file_path"), rf".*/{re.escape(table)}/(v\d{{8}}.*)$", 1)
        return rows.select("*", path.alias(FILE))

    def _measured(self, table: str, rows: DataFrame, key: str) -> DataFrame:
        """Manifest entries of the files that hold ``rows``; reads their keys."""
        of = F.col(f"`{key}`").cast("string")
        files = self._filed(table, rows.select(key)).groupBy(F.col(FILE).alias("path"))
        return files.agg(F.count(F.lit(1)).alias("rows"), F.min(of).alias("low"), F.max(of).alias("high"))

    def live_files(self, table: str, key: str) -> DataFrame:
        """``(path, rows, low, high)`` of the files that make up the table."""
        folder = self.location(table)
        if self._about(folder).get("key") == key:
            return self._manifest(folder)
        # A version written whole, or measured by another key.
        return self._measured(table, self.read(table), key)

    def read_filed(self, table: str) -> DataFrame:
        """The current rows with the file of each, for ``change``."""
        return self._filed(table, self.read(table)) if self.exists(table) else self.read(table).withColumn(FILE, F.lit(None).cast("string"))

    def _entries(self, table: str, key: str) -> list[Row]:
        """The manifest on the driver: one entry per file."""
        with shuffles_given_back(self.spark):
            return self.live_files(table, key).collect() if self.exists(table) else []

    def _touched(self, table: str, key: str, keys: DataFrame, entries: list[Row]) -> tuple[set[str], int]:
        """Paths of the files that hold one of the keys, and the number of rows in ``keys``.

        The bounds leave out files of other ranges, a semi join over the key
        column alone decides on the others.
        """
        of = F.col(f"`{key}`")
        with shuffles_given_back(self.spark):
            ends = keys.agg(F.min(of.cast("string")).alias("low"), F.max(of.cast("string")).alias("high"), F.count(F.lit(1)).alias("n")).first()
        near = [e["path"] for e in entries if ends["low"] is not None and e["low"] is not None and e["low"] <= ends["high"] and e["high"] >= ends["low"]]
        if not near:
            return set(), ends["n"]
        listed = keys.where(of.isNotNull()).select(of.alias("__listed")).distinct()
        rows = self._filed(table, self._rows_of(table, near).select(key))
        with shuffles_given_back(self.spark):
            met = rows.join(listed, of == F.col("__listed"), "left_semi")
            return {row[FILE] for row in met.select(FILE).distinct().collect()}, ends["n"]

    def read_keys(self, table: str, key: str, keys: DataFrame) -> DataFrame:
        """The rows of the files that hold one of the keys."""
        return self._rows_of(table, sorted(self._touched(table, key, keys, self._entries(table, key))[0]))

    def merge(self, table: str, key: str, batch: DataFrame, images: Callable[[DataFrame], DataFrame], token: str | None = None, feed: bool = True) -> DataFrame:
        """Change the files that hold a key of the batch; ``images`` as for ``change``.

        Without ``feed`` the version keeps no change feed: only its rows are written.
        """
        entries = self._entries(table, key)
        paths, more = self._touched(table, key, batch, entries)
        return self._commit(table, key, entries, paths, images, token, more, feed)

    def change(self, table: str, key: str, files: DataFrame, images: Callable[[DataFrame], DataFrame], token: str | None = None) -> DataFrame:
        """Write a version in which only the named files are replaced.

        ``files`` has the paths in the column ``FILE``. ``images(rows)`` gets the
        rows of these files and returns structs ``before`` and ``after`` of the
        table's columns, one pair for every row and every new row: equal where
        nothing changes, ``before`` NULL for an insert, ``after`` NULL for a
        delete. No file, no new version.
        """
        paths = {row[FILE] for row in files.select(FILE).distinct().collect()}
        return self._commit(table, key, self._entries(table, key), paths, images, token) if paths else self.read(table)

    def delete(self, table: str, key: str, keys: DataFrame, token: str | None = None) -> DataFrame:
        """Take out the rows of the keys."""
        listed = keys.select(F.col(f"`{key}`").alias("__listed")).where("__listed IS NOT NULL").distinct()

        def images(rows: DataFrame) -> DataFrame:
            row = F.struct([F.col(f"`{c}`") for c in rows.columns])
            found = rows.join(listed, F.col(f"`{key}`") == F.col("__listed"), "left")
            return found.select(row.alias("before"), F.when(F.col("__listed").isNull(), row).alias("after"))

        entries = self._entries(table, key)
        paths, _ = self._touched(table, key, keys, entries)
        return self._commit(table, key, entries, paths, images, token) if paths else self.read(table)

    def insert(self, table: str, key: str, rows: DataFrame, token: str | None = None) -> DataFrame:
        """Add rows as files of their own; the feed reads them from there."""
        rows = rows.select([F.col(f"`{c}`") for c in (self._type(table).fieldNames() if table in schemas.KNOWN or self.exists(table) else rows.columns)])
        folder = self._next_folder(table, token)
        with shuffles_given_back(self.spark):
            rows.write.mode("overwrite").parquet(f"{folder}/{_FILES}/image=row")
        return self._publish(table, key, folder, self._entries(table, key), rows.schema, inserted=True)

    def _commit(
        self, table: str, key: str, entries: list[Row], paths: set[str], images: Callable[[DataFrame], DataFrame], token: str | None, more: int = 0, feed: bool = True
    ) -> DataFrame:
        """Replace the files ``paths`` of ``entries``; ``more`` rows may come to theirs."""
        size = sum(e["rows"] for e in entries if e["path"] in paths) + more
        found = images(self._rows_of(table, sorted(paths)) if self.exists(table) else self.read(table))
        fields = found.schema["after"].dataType
        # Of a row that does not change one image travels, and without a feed none that leaves.
        changed = ~F.col("before").eqNullSafe(F.col("after"))
        if feed:
            found = found.select(F.when(changed, F.col("before")).alias("before"), "after", (F.col("before").isNull()).alias("is_new"))
        else:
            found = found.where("after IS NOT NULL").select(F.lit(None).cast(fields).alias("before"), "after", F.lit(False).alias("is_new"))
        # By ranges of the key, so that the bounds in the manifest tell files apart; rows without key are spread.
        row = F.coalesce("after", "before")
        found = found.repartitionByRange(max(-(-size // ROWS_PER_FILE), 1), row[key], F.xxhash64(row))

        def image(name: str, of: str, when: Column) -> Column:
            return F.when(when, F.struct(F.lit(name).alias("image"), F.col(of).alias("row")))

        # ``before`` is there only of rows that change or go.
        left, stays = F.col("before").isNotNull(), F.col("after").isNotNull()
        written = F.array(
            image("row", "after", stays),
            image("insert", "after", F.col("is_new")),
            image("delete", "before", left & ~stays),
            image("before", "before", left & stays),
            image("after", "after", left & stays),
        )
        folder = self._next_folder(table, token)
        found = found.select(F.explode(F.array_compact(written)).alias("x")).select("x.image", "x.row.*")
        with shuffles_given_back(self.spark):
            found.write.mode("overwrite").partitionBy("image").parquet(f"{folder}/{_FILES}")
        return self._publish(table, key, folder, [e for e in entries if e["path"] not in paths], fields, inserted=False, feed=feed)

    def _publish(self, table: str, key: str, folder: str, kept: list[Row], fields: StructType, inserted: bool, feed: bool = True) -> DataFrame:
        """List kept and new files; the version counts from its last line on."""
        entries = [tuple(e) for e in kept]
        if self._exists(f"{folder}/{_FILES}/image=row"):
            rows = self.spark.read.schema(fields).parquet(f"{folder}/{_FILES}/image=row")
            with shuffles_given_back(self.spark):
                entries += [tuple(e) for e in self._measured(table, rows, key).collect()]
        self.spark.createDataFrame(entries, _ENTRIES).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{_MANIFEST}")
        about = json.dumps({"key": key, "inserted": inserted, "feed": feed, "schema": json.loads(fields.json())})
        stream = self._fs.create(self._path(f"{folder}/{_ABOUT}"), True)
        stream.write(bytearray(about.encode()))
        stream.close()
        self._mark(f"{folder}/_SUCCESS")
        return self.read(table)

    def version(self, table: str) -> int:
        """Number of the current version, 0 before the first."""
        versions = self._versions(table)
        return versions[-1][0] if versions else 0

    def changes(self, table: str, after: int, upto: int | None = None) -> DataFrame:
        """The change feed: ``version``, ``image`` and the row, for versions above ``after`` up to ``upto``.

        ``insert`` and ``delete`` are single images, an update has the images
        ``before`` and ``after``. Only images are read. A version that was
        written whole or is deleted has no feed, and asking for it fails.
        """
        last = self.version(table) if upto is None else upto
        folders = {number: folder for number, _, folder in self._versions(table)}
        fields = self._type(table)
        feed = self.spark.createDataFrame([], StructType(list(fields.fields)).add("image", "string").add("version", "long"))
        for number in range(after + 1, last + 1):
            about = self._about(folders[number]) if number in folders else {}
            if not about.get("feed", bool(about)):
                raise ValueError(f"version {number} of {table} has no change feed")
            images = self.spark.read.schema(StructType(list(fields.fields)).add("image", "string")).parquet(f"{folders[number]}/{_FILES}")
            if about["inserted"]:
                images = images.withColumn("image", F.lit("insert"))
            else:
                images = images.where(F.col("image").isin(*IMAGES))
            feed = feed.unionByName(images.withColumn("version", F.lit(number).cast("long")))
        return feed.select("version", "image", *fields.fieldNames())

    def prune(self, table: str, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions, except for files that these still list."""
        if keep < 1:
            raise ValueError("at least one version must stay")
        versions = self._versions(table)
        for _, token, _ in versions[:-keep]:
            if token:
                self._mark(self._token_file(table, token))
        if not versions[:-keep]:
            return
        needed: set[str] = set()
        for _, _, folder in versions[-keep:]:
            if self._exists(f"{folder}/{_MANIFEST}"):
                needed |= {row["path"] for row in self._manifest(folder).collect()}
        owners = {path.split("/", 1)[0] for path in needed}
        for status in self._fs.listStatus(self._path(f"{self.root}/{_safe(table)}")):
            name = status.getPath().getName()
            match = _VERSION.match(name)
            if not match or int(match[1]) >= versions[-keep][0]:
                continue
            folder = f"{self.root}/{table}/{name}"
            if name not in owners:
                self._fs.delete(self._path(folder), True)
                continue
            # No version any more, but home of files that live on.
            for gone in ("_SUCCESS", _MANIFEST, _ABOUT):
                self._fs.delete(self._path(f"{folder}/{gone}"), True)
            files = self._fs.listFiles(self._path(folder), True)
            while files.hasNext():
                path = files.next().getPath()
                below = path.toString().rsplit(f"/{table}/{name}/", 1)[1]
                if f"{name}/{below}" not in needed:
                    self._fs.delete(path, False)

    def drop(self, table: str) -> None:
        """Delete a table with all its versions and tokens."""
        self._fs.delete(self._path(f"{self.root}/{_safe(table)}"), True)

    def compact(self, table: str, keep: str, batch_count: int = 16) -> None:
        """Fold the batches of an appended table into few, once there are more than ``batch_count``.

        ``keep`` names a batch that must stay as it is, as a run that is
        repeated looks for it. Names of folded batches stay known as tokens.
        """
        if not self.exists(table):
            return
        folder = self.location(table)
        names = [st.getPath().getName() for st in self._fs.listStatus(self._path(folder))]
        names = [n.removeprefix(f"{BATCH}=b-") for n in names if n.startswith(f"{BATCH}=b-")]
        old = [n for n in names if n != keep and not n.startswith(f"{keep}-")]
        if len(old) <= batch_count:
            return
        for name in old:
            self._mark(self._token_file(table, f"batch-{name}"))
        folded = F.when(F.col(BATCH).isin([f"b-{n}" for n in old]), F.lit("b-folded")).otherwise(F.col(BATCH))
        self.rewrite(table, lambda rows: rows.withColumn(BATCH, folded))


def replayed(rows: DataFrame, feed: DataFrame) -> DataFrame:
    """The rows after the changes of a feed, copies of a row counted."""
    sign = F.when(F.col("image").isin("insert", "after"), 1).otherwise(-1)
    signed = rows.withColumn("__n", F.lit(1)).unionByName(feed.withColumn("__n", sign).drop("image", "version"))
    left = signed.groupBy(rows.columns).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    short = F.when(F.col("__n") < 0, F.raise_error(F.lit("the feed takes out a row that is not there")).cast("int"))
    return left.select("*", F.explode(F.array_repeat(F.lit(0), F.coalesce(short, F.col("__n").cast("int"))))).select(rows.columns)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``, one row per table, also for empty ones."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    union = counts[0]
    for df in counts[1:]:
        union = union.unionByName(df)
    return union
