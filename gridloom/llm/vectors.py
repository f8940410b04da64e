"""Reading vectors and fitting codebooks, shared by the two embedding operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import hash_sample


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, and not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array<double> column whose rows all have ``dim`` components."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def unit(x: np.ndarray) -> np.ndarray:
    peak = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(peak > 0, peak, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def bounded_sample(vectors: DataFrame, id_column: str, limit: int) -> np.ndarray:
    """Unit vectors of the ``limit`` rows with the smallest hashes of their ids and components (column v, one length)."""
    found = hash_sample(vectors.select(id_column, "v"), F.xxhash64(id_column, "v"), limit).select("v").toArrow().column("v").combine_chunks()
    return unit(matrix(found, len(found[0]))) if len(found) else np.zeros((0, 0))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their peaks: no component's bits change, and no square overflows."""
    _, exponent = np.frexp(np.abs(x).max(axis=-1, keepdims=True))
    return np.ldexp(x, -exponent)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T, 0)


#: Rows whose distances to all centres are held at a time.
ROWS = 1000


def nearest_center(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    if not len(x):
        return np.zeros(0, dtype=np.int64)
    return np.concatenate([distances(x[at : at + ROWS], centers).argmin(axis=1) for at in range(0, len(x), ROWS)])


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm on a bounded sample, from evenly spaced rows; an empty cell keeps its centroid."""
    k = max(1, min(k, len(x)))
    centers = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest_center(x, centers)
        count = np.bincount(near, minlength=k)
        for d in range(x.shape[1]):
            sums = np.bincount(near, weights=x[:, d], minlength=k)
            centers[:, d] = np.where(count > 0, sums / np.maximum(count, 1), centers[:, d])
    return centers


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches grouped by their first ``keys`` columns. Groups are bounded by the caller's blocks."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_numpy(zero_copy_only=False) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:keys] != held[-1][:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held
