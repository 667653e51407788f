"""Rows of vectors inside Arrow batches: which of them are whole, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE = 256
LARGEST = 1 << 24   # of an integer component: squares of differences then fit 64 bits, for up to 2^13 components


def whole(column: str) -> Column:
    """Whether the vector has components, which are all there and finite."""
    x = F.col(column).cast("array<double>")
    return F.coalesce((F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def whole_rows(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows with a whole vector, as ``vec_id``, ``label`` and ``embedding``; other columns are left out."""
    return vectors.where(whole(column)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col(column).cast("array<double>").alias("embedding"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 x) of each component; all vectors have ``width`` components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(SCALE * flat)
    if len(scaled) and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // SCALE}: its squares do not fit 64-bit sums")
    return scaled.astype(np.int64).reshape(-1, width)


def same_width(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Rows whose vector is as long as that of the smallest id, and this length; 0 if there are no rows."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select(F.size("embedding").alias("n")).first()
    width = first["n"] if first else 0
    return vectors.where(F.size("embedding") == width), width
