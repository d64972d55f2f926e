"""Embeddings as rows that can be compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimensions(rows: DataFrame, vector: str = "embedding") -> list[int]:
    """The numbers of components there are; vectors of different ones are not compared."""
    sizes = rows.where(usable(F.col(vector))).select(F.size(vector).alias("dim")).distinct()
    return sorted(row.dim for row in sizes.collect())


def comparable(rows: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Rows with usable vectors of one dimension."""
    return rows.where(usable(F.col(vector)) & (F.size(vector) == dim))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def units(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very small or large components stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosines of a vector with others; equal vectors get equal values wherever they stand."""
    top = np.abs(one).max()
    one, many = one / top, many / np.abs(many).max(axis=1, keepdims=True)
    return (many * one).sum(axis=1) / np.sqrt((one * one).sum() * (many * many).sum(axis=1))
