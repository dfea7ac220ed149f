"""Vectors as bytes: which rows count, and their exact values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def usable(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, vector) for every vector that is not null, empty, zero or partly null or non-finite."""
    for i, cell in enumerate(column):
        if not cell.is_valid or cell.values is None or cell.values.null_count or not len(cell.values):
            continue
        vector = cell.values.to_numpy(zero_copy_only=False)
        if vector.dtype not in (np.float32, np.float64):
            vector = vector.astype(np.float64)
        if np.isfinite(vector).all() and vector.any():
            yield i, vector


def doubles(raw: bytes, single: bool) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if single else np.float64).astype(np.float64)


def pair_cosines(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 1 << 17) -> np.ndarray:
    """Cosine in double precision of the pairs (left[i], right[j]), some at a time."""
    a, b = np.sqrt(np.einsum("ij,ij->i", left, left)), np.sqrt(np.einsum("ij,ij->i", right, right))
    out = np.empty(len(i))
    for k in range(0, len(i), step):
        x, y = i[k : k + step], j[k : k + step]
        out[k : k + step] = np.einsum("ij,ij->i", left[x], right[y]) / (a[x] * b[y])
    return out
