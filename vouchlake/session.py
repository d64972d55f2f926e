"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_shipped: set[str] = set()

# ANSI makes a bad cast fail the job instead of turning into NULL; UTC keeps
# timestamp text independent of the machine. The join operators count on the
# adaptive settings for hot keys; forcing lets Spark split one in a join whose
# output another join on the same key takes over, at the price of one shuffle.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """Jobs planned and run inside delete their shuffles when they end.

    For jobs of which nothing is read again but what they write or return. Else
    the files lie there until the driver happens to collect its garbage.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def local_session(cores: str = "*", app: str = "vouchlake", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session, for tests and benchmarks only."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's temporary folder: on a
    cluster the executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="vouchlake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the session was started from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vouchlake-"), "vouchlake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
