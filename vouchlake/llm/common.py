"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchlake.session import scratch_dir, shuffles_given_back

# A word: code points other than blank and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read from there.

    Cuts the lineage: what later steps read survives a lost executor, and is
    computed once however many of them read it. The shuffles of this one job are
    given back when it has ended, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with shuffles_given_back(spark):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def given_back(*tables: DataFrame) -> None:
    """Deletes what ``stored`` wrote for these; for tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside gives Python at most so many rows at once.

    A batch is held on both sides, in and out, by each task of an executor; rows
    that carry texts or sets of hashes make the usual 10,000 too many.
    """
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: str = "text") -> Column:
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
