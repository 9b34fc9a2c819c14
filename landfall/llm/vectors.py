"""Vectors in columns: which of them count, and their components as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGEST = 2**63 - 1


def doubles(name: str) -> Column:
    """A vector's components in double precision."""
    return F.col(name).cast("array<double>")


def is_finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    within = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(within, F.lit(False))


def longest(df: DataFrame, name: str) -> int:
    """The number of components of the longest vector, 0 without vectors."""
    return df.agg(F.max(F.size(name))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors without NULL as the rows of a matrix; shorter ones end in zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def whole_numbers(x: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit integers; raises where a product of two such vectors might not fit in 64 bits."""
    scaled = np.floor(scale * x)
    largest = float(np.abs(scaled).max(initial=0.0))
    if 4.0 * largest * largest * max(x.shape[-1], 1) >= LARGEST:
        raise OverflowError(f"components up to {largest / scale:g} give products beyond 64 bits")
    return scaled.astype(np.int64)


def binary_rows(x: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    x = np.ascontiguousarray(x)
    at = np.arange(len(x) + 1, dtype=np.int64) * (x.shape[1] * x.itemsize)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(x), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(x.tobytes())]
    ).cast(pa.binary())


def lists(x: np.ndarray) -> pa.Array:
    """Each row of a matrix as a list."""
    at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(at, np.ascontiguousarray(x).reshape(-1))


def from_binary(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    """The matrix whose rows :func:`binary_rows` has written."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), width)


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to so many rows at most."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
