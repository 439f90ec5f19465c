"""Embedding columns as exact integer matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite entries; false for a null vector."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def integer_entries(vector: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * entry) + shift, entries taken as doubles."""
    return F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))) + F.lit(shift))


def widest(rows: DataFrame, vector: str) -> int:
    """Entries of the longest vector (0 without rows)."""
    return int(rows.agg(F.max(F.size(vector))).first()[0] or 0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an int64 list column as a matrix; shorter rows are filled up with 0."""
    column = column.cast(pa.large_list(pa.int64()))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(flat) == len(size) * width:
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def largest(*parts: np.ndarray) -> int:
    """Largest absolute entry, as a Python number (no overflow)."""
    return max((max(int(p.max()), -int(p.min())) for p in parts if p.size), default=0)


def exact_kind(bound: int) -> type:
    """The fastest type whose sums of products up to ``bound`` are exact: floating point
    while every sum is an exact number of it, then 64-bit integers, then Python's."""
    for bits, kind in ((24, np.float32), (53, np.float64), (63, np.int64)):
        if bound < 2**bits:
            return kind
    return object


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integers, exactly."""
    kind = exact_kind(largest(a) * largest(b) * max(1, a.shape[1]))
    out = a.astype(kind) @ b.astype(kind)
    return out if kind is object else out.astype(np.int64)
