"""Helpers for vector columns: which vectors take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(c: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(c) > 0) & ~bad & F.exists(c, lambda x: x != 0), F.lit(False))


def dimension(df: DataFrame, column: str) -> int:
    """The one length of all usable vectors; other lengths fail clearly.  Two numbers reach the driver."""
    r = df.agg(F.min(F.size(column)).alias("lo"), F.max(F.size(column)).alias("hi")).first()
    if r["lo"] != r["hi"]:
        raise ValueError(f"vectors have {r['lo']} to {r['hi']} components; one length is needed")
    return r["lo"] or 0


def matrix(col: pa.Array, dim: int, dtype=np.float64) -> np.ndarray:
    """An Arrow list column without nulls as a matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), dtype).reshape(len(col), dim) if len(col) else np.zeros((0, dim), dtype)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component, so equal rows give equal bits."""
    s = np.zeros(len(a))
    for j in range(a.shape[1]):
        s += a[:, j] * b[:, j]
    return s
