"""Integer vectors of list columns."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has components, all of them finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.filter((F.size(vector) > 0) & ~odd)


def floored(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers where they fit, else as Python's."""
    wide = np.floor(values.astype(np.float64) * scale)
    if not wide.size or np.abs(wide).max() < 2.0**62:
        return wide.astype(np.int64)
    exact = [math.floor(scale * x) if math.isinf(y) else int(y) for x, y in zip(map(_exact, values.ravel().tolist()), wide.ravel().tolist())]
    out = np.empty(wide.size, object)
    out[:] = exact
    return out.reshape(wide.shape)


def _exact(x: float):
    """A double as a number whose products do not overflow."""
    return int(x) if abs(x) > 2.0**60 else x


def vectors_of(column: pa.Array, scale: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integer components padded with zeros to ``length``)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
    flat = column.flatten()
    good = np.isfinite(values := flat.to_numpy(zero_copy_only=False).astype(np.float64)) & ~np.isnan(values)
    row = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.bincount(row[~good], minlength=len(sizes)) > 0 if len(row) else np.zeros(len(sizes), bool)
    kept = np.flatnonzero((sizes > 0) & ~bad)
    ints = floored(values[~bad[row]] if len(row) else values, scale)
    out = np.zeros((len(kept), length), ints.dtype)
    n = sizes[kept]
    if len(kept):
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(np.arange(len(kept)), n), at] = ints
    return kept, out
