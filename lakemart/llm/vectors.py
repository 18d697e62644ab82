"""Vectors as checked double matrices, and k-means on a bounded sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, no null, NaN or infinite component, and not all zero."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(
        x.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of equal length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and small values."""
    if not x.size:
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b`` in double precision."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) if x.size else x for x in (a, b))
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def dimension(vectors: DataFrame, column: str) -> int:
    """The commonest length of the usable vectors; 0 without any."""
    row = vectors.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return int(row.d) if row else 0


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of ``k`` clusters of unit rows; fewer if there are fewer different rows."""
    rng = np.random.default_rng(seed)
    different = np.unique(x, axis=0)
    centres = different[rng.permutation(len(different))[:k]]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where((norm > 0)[:, None], sums / np.maximum(norm, 1e-300)[:, None], centres)
    return centres
