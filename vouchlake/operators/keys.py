"""Joins against a set of keys, shared by all operators.

Two things keep one hot key from landing in one task. Sets are made distinct,
so that copies of a key fold in the map tasks before the shuffle. And joins
compare keys with ``same_key``, which lets Spark split a hot key on the other
side: adaptive execution splits a partition only where both inputs of the join
are plain shuffles of that join, and a set made distinct by the key alone would
be joined without a shuffle of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


Hash = Callable[[Column], Column]


def same_key(left: Column, right: Column, by: Hash = F.xxhash64) -> Column:
    """Key equality with the keys' hashes beside it; NULL equals nothing.

    The hash adds no condition. It makes the join shuffle by (hash, key), which
    an earlier grouping by the key does not satisfy, and sorts by number first.
    A join right after another one on the same key takes another hash function
    (``by``) to get a shuffle of its own again.
    """
    return (by(left) == by(right)) & (left == right)


def key_set(df: DataFrame, key: str, name: str) -> DataFrame:
    """The distinct non-NULL keys under another name."""
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias(name)).distinct()


def cascade(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent holds; NULL keys drop out."""
    return within(child, parent, key, key)


def within(child: DataFrame, keys: DataFrame, child_key: str, key: str, by: Hash = F.xxhash64) -> DataFrame:
    """Child rows whose key is in the set; NULL keys drop out."""
    listed = key_set(keys, key, "__listed")
    return child.join(listed, same_key(F.col(child_key), F.col("__listed"), by), "left_semi")


def without(child: DataFrame, keys: DataFrame, child_key: str, key: str, by: Hash = F.xxhash64) -> DataFrame:
    """Child rows whose key is not in the set; NULL keys stay."""
    listed = key_set(keys, key, "__listed")
    return child.join(listed, same_key(F.col(child_key), F.col("__listed"), by), "left_anti")


def marked(df: DataFrame, keys: DataFrame, df_key: str, key: str, mark: str) -> DataFrame:
    """Every row, with a flag column telling whether its key is in the set."""
    listed = key_set(keys, key, "__listed")
    return (
        df.join(listed, same_key(F.col(df_key), F.col("__listed")), "left")
        .withColumn(mark, F.col("__listed").isNotNull())
        .drop("__listed")
    )
