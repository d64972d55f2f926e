"""Incremental pick-up of landing CSVs."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.operators.upsert import raw_images
from vouchlake.sinks.store import TableStore
from vouchlake.sources.csv_drops import FIXED_OPTIONS, restore_empty

FILE_TIME, FILE_NAME = "__file_time", "__file"


def newest_drop(table: str, rows: DataFrame) -> DataFrame:
    """Rows of several files, each key from the newest file that has it.

    An order goes by its own version first, as only a newer one may replace
    it. A key that two files of one time bring fails the job, since nothing
    tells which came last. Rows without key, and copies within one file, stay.
    """
    key = schemas.KEYS[table]
    order = [F.desc(FILE_TIME)]
    if table == "orders":
        order.insert(0, F.desc_nulls_last(F.col("source_updated_at").try_cast("timestamp")))
    # Rows without key are spread; they are not compared.
    by = Window.partitionBy(F.col(key), F.when(F.col(key).isNull(), F.xxhash64(*rows.columns)))
    place = F.rank().over(by.orderBy(*order))
    first = rows.withColumn("__place", place).where(F.col(key).isNull() | (F.col("__place") == 1))
    files = F.size(F.collect_set(FILE_NAME).over(by))
    clash = F.concat(F.lit("files of one time bring key "), F.col(key).cast("string"))
    checked = F.when(F.col(key).isNotNull() & (files > 1), F.raise_error(clash).cast("string")).otherwise(F.col(FILE_NAME))
    return first.withColumn(FILE_NAME, checked).where(F.col(FILE_NAME).isNotNull()).drop("__place", FILE_TIME, FILE_NAME)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name no other stream has: the id that Spark wrote when the checkpoint was made."""
    written = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return hashlib.sha256(json.loads(written.value)["id"].encode()).hexdigest()[:24]


def merge_drops(store: TableStore, table: str, rows: DataFrame, token: str, moment: datetime) -> None:
    """Merge the rows of several files, told apart by time and name, into the raw table."""
    cells = restore_empty(rows, schemas.STAGE[table].fieldNames())
    stage = store.replace(f"{table}_stage", newest_drop(table, cells))
    store.merge(f"{table}_raw", schemas.KEYS[table], stage, lambda held: raw_images(table, held, stage, moment), token)


def ingest_incremental(
    spark: SparkSession,
    store: TableStore,
    table: str,
    drop_root: str,
    checkpoint: str,
    as_of: datetime | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Merge every CSV that is new below ``drop_root``, then stop.

    All waiting files make one merge unless ``files_per_batch`` says otherwise;
    of a key that several bring, ``newest_drop`` tells which row counts. Each
    drop needs a name of its own, as a rewritten file of a known name is not
    picked up again. A merge carries the stream's id and the number of its
    micro-batch as version token, so one repeated after a failure is not
    applied twice, and a stream with another or a new checkpoint is.
    """
    raw = f"{table}_raw"
    reader = (
        spark.readStream.schema(schemas.STAGE[table])
        .options(**FIXED_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    drops = reader.csv(drop_root).select(
        "*", F.col("_metadata.file_modification_time").alias(FILE_TIME), F.col("_metadata.file_path").alias(FILE_NAME)
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        token = f"{stream_name(spark, checkpoint)}-{batch_id}"
        if store.has_token(raw, token):
            return
        merge_drops(store, table, batch, token, as_of or datetime.now(timezone.utc))

    query = (
        drops.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read(raw)
