"""File moves as data: plans, a collision check, and a distributed applier."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.names import archived_csv, is_csv
from vouchlake.functions.values import instant
from vouchlake.session import ship_package

PLAN_COLUMNS = ["source_path", "dest_path", "zone"]


def plan_csv_archive(listing: DataFrame, run_time: datetime, with_time: bool = False) -> DataFrame:
    """Moves of loaded CSVs: only files updated before the run's own time.

    ``with_time`` keeps that update time, for a mover that leaves alone what
    was written again since.
    """
    path, updated = F.col("path"), F.col("modificationTime")
    return listing.filter(is_csv(path) & (updated < instant(run_time))).select(
        path.alias("source_path"),
        archived_csv(path, updated).alias("dest_path"),
        F.lit(schemas.PROCESSED).alias("zone"),
        *([updated.alias("updated")] if with_time else []),
    )


def plan_document_moves(classified: DataFrame) -> DataFrame:
    """Moves of classified documents; ignored files have no destination."""
    zone = F.when(F.col("outcome") == "valid", schemas.ARCHIVE_PDF).otherwise(schemas.ERROR_PDF)
    return classified.filter(F.col("dest_path").isNotNull()).select(
        F.col("path").alias("source_path"), "dest_path", zone.alias("zone")
    )


def collisions(plan: DataFrame) -> DataFrame:
    """Destinations that more than one source would take."""
    return plan.groupBy("dest_path").agg(F.count(F.lit(1)).alias("sources")).filter(F.col("sources") > 1)


def require_distinct_destinations(plan: DataFrame) -> None:
    found = collisions(plan).first()
    if found is not None:
        raise ValueError(
            f"{found['sources']} files would move to {found['dest_path']}; rename all but one and start a new run"
        )


def file_system(root: str):
    """The Arrow file system of a root folder and the path inside it."""
    from pyarrow import fs as afs

    if "://" not in root:
        root = f"file://{root.removeprefix('file:')}"
    store, base = afs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
    return store, base.rstrip("/")


def _later(now, then) -> bool:
    """Whether a file was written again; listings keep milliseconds at least."""
    return pd.Timestamp(now) - pd.Timestamp(then, tz="UTC") > pd.Timedelta(milliseconds=1)


def _move_batches(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as afs

        store, base = file_system(root)
        made: set[str] = set()
        for batch in batches:
            sources = [f"{base}/{p}" for p in batch["source_path"]]
            dests = [f"{base}/{p}" for p in batch["dest_path"]]
            # One call for the whole batch.
            there = store.get_file_info(sources + dests) if sources else []
            known = batch["updated"] if "updated" in batch else [None] * len(sources)
            outcomes = []
            for source, dest, found, taken, updated in zip(sources, dests, there, there[len(sources) :], known, strict=False):
                gone, free = (f.type == afs.FileType.NotFound for f in (found, taken))
                if gone:
                    # A second attempt of this task finds its work done.
                    outcomes.append("missing" if free else "done_before")
                elif not free:
                    outcomes.append("taken")
                elif updated is not None and not pd.isna(updated) and _later(found.mtime, updated):
                    outcomes.append("changed")
                else:
                    folder = dest.rsplit("/", 1)[0]
                    if folder not in made:
                        store.create_dir(folder, recursive=True)
                        made.add(folder)
                    store.move(source, dest)
                    outcomes.append("moved")
            yield batch[PLAN_COLUMNS].assign(outcome=outcomes)

    return run


def apply_moves(plan: DataFrame, root: str, files_per_task: int = 500, checked: bool = False) -> dict[tuple[str, str], int]:
    """Carry out a written plan of paths relative to ``root``, in the tasks.

    Two sources for one destination stop the run before the first move, unless
    the plan was ``checked`` when it was made. Nothing is overwritten: where the
    destination exists the source stays, as ``taken``. With an ``updated``
    column a source written again since then stays, as ``changed``. The result
    counts the files per (zone, outcome), a handful of rows.
    """
    ship_package(plan.sparkSession)
    if not checked:
        require_distinct_destinations(plan)
    # Rows are few bytes each but a move is slow, so tasks are cut by count.
    tasks = -(-plan.count() // files_per_task)
    columns = [*PLAN_COLUMNS, *[c for c in ("updated",) if c in plan.columns]]
    moved = plan.select(columns).repartition(max(tasks, 1), "source_path").mapInPandas(
        _move_batches(root), "source_path string, dest_path string, zone string, outcome string"
    )
    tally = moved.groupBy("zone", "outcome").count().collect()
    return {(row["zone"], row["outcome"]): row["count"] for row in tally}


def require_moved(tally: dict[tuple[str, str], int], tolerated: tuple[str, ...] = ()) -> None:
    """Fail where files of a plan stayed behind or were not there."""
    left = {k: n for k, n in tally.items() if k[1] in ("missing", "taken") and k[1] not in tolerated}
    if left:
        raise RuntimeError(f"files not moved, by zone and reason: {left}")
