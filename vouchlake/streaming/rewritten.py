"""Incremental pick-up of landing CSVs that are written again under their own names.

Spark's file source knows a file by its name, so a drop that replaces the one
before it is never read. Here a small streaming source emits the files whose
update time or length differs from the last offset, and the offset is the
listing itself: name, update time and length of every file that is there. It
stays as small as the drop folder, which the archive empties. The rows are
read by Spark's own CSV reader inside the micro-batch.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from vouchlake import schemas
from vouchlake.session import ship_package
from vouchlake.sinks.store import TableStore
from vouchlake.streaming.drops import FILE_TIME, FILE_NAME, merge_drops, stream_name
from vouchlake.sources.csv_drops import FIXED_OPTIONS

FILES_PER_TASK = 1000


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


class _DropReader(DataSourceStreamReader):
    def __init__(self, root: str, suffix: str):
        self.root, self.suffix = root, suffix

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        """Name, update time in milliseconds and length of the files that are there now."""
        from pyarrow import fs as afs

        from vouchlake.sinks.moves import file_system

        store, base = file_system(self.root)
        found = store.get_file_info(afs.FileSelector(base, allow_not_found=True, recursive=True))
        files = [f for f in found if f.type == afs.FileType.File and f.path.endswith(self.suffix)]
        return {"files": {f.path[len(base) + 1 :]: {"moment": f.mtime_ns // 1_000_000, "length": f.size} for f in files}}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        known = start["files"]
        changed = [(path, f["moment"], f["length"]) for path, f in sorted(end["files"].items()) if known.get(path) != f]
        return [_Files(changed[k : k + FILES_PER_TASK]) for k in range(0, len(changed), FILES_PER_TASK)]

    def read(self, partition: InputPartition):
        yield from partition.files

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the offsets."""


class LandingDrops(DataSource):
    """Streaming source of the files that came or changed below ``root``: ``path, moment, length``."""

    @classmethod
    def name(cls) -> str:
        return "landing_drops"

    def schema(self) -> str:
        return "path string, moment bigint, length bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _DropReader(self.options["root"], self.options.get("suffix", ".csv"))


def read_as_listed(spark: SparkSession, table: str, root: str, files: DataFrame) -> DataFrame | None:
    """The rows of listed files that are still as they were listed; None if no file is left.

    A file written again since then is left to the next batch, which lists it anew.
    """
    listed = files.collect()  # the files that changed, not their rows
    base, paths = root.rstrip("/"), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = paths(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [f"{base}/{row.path}" for row in listed if system.exists(paths(f"{base}/{row.path}"))]
    if not there:
        return None
    reader = spark.read.options(**FIXED_OPTIONS).option("ignoreMissingFiles", "true")
    rows = reader.csv(there, schema=schemas.STAGE[table]).select(
        "*", F.col("_metadata.file_modification_time").alias(FILE_TIME), F.col("_metadata.file_path").alias(FILE_NAME), F.col("_metadata.file_size").alias("__length")
    )
    kept = files.select(F.col("moment").alias("__moment"), F.col("length").alias("__listed"), F.col("path").alias("__path"))
    below = F.url_decode(F.replace(F.col(FILE_NAME), F.lit("+"), F.lit("%2B"))).endswith(F.concat(F.lit("/"), F.col("__path")))
    same = (F.unix_millis(FILE_TIME) == F.col("__moment")) & (F.col("__length") == F.col("__listed")) & below
    return rows.join(kept, same, "left_semi").drop("__length")


def ingest_rewritten(
    spark: SparkSession, store: TableStore, table: str, drop_root: str, checkpoint: str, as_of: datetime | None = None
) -> DataFrame:
    """Merge every CSV below ``drop_root`` that is new or was written again, then stop.

    As ``ingest_incremental``, but a drop may keep its name. A merge carries the
    stream's id and the number of its micro-batch, so a batch that is repeated
    after a failure is not applied twice.
    """
    ship_package(spark)
    spark.dataSource.register(LandingDrops)
    drops = spark.readStream.format("landing_drops").option("root", drop_root).load()

    def merge(batch: DataFrame, batch_id: int) -> None:
        token = f"{stream_name(spark, checkpoint)}-{batch_id}"
        if store.has_token(f"{table}_raw", token):
            return
        rows = read_as_listed(spark, table, drop_root, batch)
        if rows is not None:
            merge_drops(store, table, rows, token, as_of or datetime.now(timezone.utc))

    query = drops.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return store.read(f"{table}_raw")
