"""Vectors as exact integers: what negatives and codes share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

#: Scaled components beyond this are taken as it: doubles are exact integers up to here.
MOST = float(1 << 53)
LONGEST = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def scaled(vectors: pa.Array, scale: int, width: int | None = None) -> np.ndarray:
    """A row per vector with floor(scale * x) of its components, zeros up to `width` (by default the longest vector's)."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -MOST, MOST)
    out = np.zeros((len(sizes), int(sizes.max(initial=0)) if width is None else width))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def integers(m: np.ndarray, products: int) -> np.ndarray:
    """The same numbers as 64-bit integers if `products` sums of two of them multiplied stay inside, else as Python's integers."""
    peak = int(np.abs(m).max(initial=0))
    exact = m.astype(np.int64)
    return exact if peak * peak * max(1, products) < 1 << 62 else exact.astype(object)


def saturated(m: np.ndarray) -> np.ndarray:
    """As 64-bit integers; what lies beyond them becomes the last one."""
    return m if m.dtype == np.int64 else np.clip(m, -LONGEST, LONGEST).astype(np.int64)
