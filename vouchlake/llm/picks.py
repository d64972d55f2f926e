"""A filter of bounded size that keeps most rows out of a shuffle.

Before large rows are joined with a few keys, those that surely have no partner
are told apart where they are read: the distinct values of a few bits of the
keys' hashes, at most ``1 << BITS`` of them however many keys there are, are
broadcast. With very many keys they let most rows through; the join that
follows is what decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20


def _spot(key: Column, part: int = 0) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), part * BITS).bitwiseAND((1 << BITS) - 1)


def _spots(keys: DataFrame, part: int = 0) -> DataFrame:
    key = F.col(f"`{keys.columns[0]}`")
    return F.broadcast(keys.where(key.isNotNull()).select(_spot(key, part).alias("spot")).distinct())


def possible(rows: DataFrame, key: str, keys: DataFrame, parts: int = 1) -> DataFrame:
    """Rows whose key may be in the one-column table, all that are among them; by so many parts of the hash, three at most."""
    for part in range(parts):
        rows = rows.alias("r").join(_spots(keys, part).alias("s"), _spot(F.col(f"r.{key}"), part) == F.col("s.spot"), "left_semi")
    return rows


def impossible(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The other rows."""
    return rows.alias("r").join(_spots(keys).alias("s"), _spot(F.col(f"r.{key}")) == F.col("s.spot"), "left_anti")
