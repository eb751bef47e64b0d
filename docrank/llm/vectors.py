"""Vectors of a table: which take part, and how tasks read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_doubles(col: str) -> Column:
    return F.col(col).cast("array<double>")


def takes_part(vec: Column, dim: int) -> Column:
    """Not null, of length ``dim``, all components finite, and not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) == dim) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def common_dim(table: DataFrame, col: str) -> int:
    """The most frequent length of the vectors (ties: the smaller); other lengths
    cannot be compared with it.  0 for a table without vectors."""
    row = (table.where(F.col(col).isNotNull() & (F.size(col) > 0)).groupBy(F.size(col).alias("d")).count()
           .orderBy(F.desc("count"), "d").limit(1).collect())
    return int(row[0].d) if row else 0


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """A list column of vectors of one length as a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (scaled by the largest component first, so that
    no square overflows or vanishes)."""
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
