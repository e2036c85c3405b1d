"""Blocks of vectors, shared by the nearest-neighbour and the dedup operator."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def valid(vectors: pa.Array) -> np.ndarray:
    """Which vectors take part: not null, not empty, not zero, all components
    finite and not null."""
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = sizes > 0
    if out.any():
        # null lists and empty ones have no components here, null components are NaN
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = (np.cumsum(sizes) - sizes)[out]
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            length = np.add.reduceat(x * x, starts)
        out[out] = np.isfinite(length) & (length > 0)
    return out


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def running_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise dot products, added up from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosines in double precision."""
    return running_dot(a, b) / (np.sqrt(running_dot(a, a)) * np.sqrt(running_dot(b, b)))


def unit(a: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so
    that very large and very small vectors don't overflow."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    return a / np.sqrt((a * a).sum(axis=1, keepdims=True))
