"""Exact inner products of vectors of whole numbers that are held as doubles."""

from __future__ import annotations

import numpy as np

#: Scores stand in 64 bits; larger ones count as the largest, smaller ones as the smallest.
MOST, LEAST = (1 << 63) - 1, -(1 << 63)


def whole_numbers(vectors: list, scale: float) -> np.ndarray:
    """floor(scale * x) of each component; what passes the range of a double counts as its largest."""
    rows = np.array(vectors, np.float64).reshape(len(vectors), -1)
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(rows * scale))


def _by_integers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    left, right = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b))
    return np.clip(left @ right.T, LEAST, MOST).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner product of each row of ``a`` with each of ``b``, in 64 bits.

    Sums under 2^53 are exact in doubles.  Rows too large for that are multiplied as
    Python's integers, they alone.
    """
    out = np.zeros((len(a), len(b)), np.int64)
    if not a.size or not b.size:
        return out
    high_a, high_b = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    with np.errstate(over="ignore"):
        if high_a.max() * high_b.max() * a.shape[1] < 1 << 53:
            return (a @ b.T).astype(np.int64)
    small = np.sqrt((1 << 53) / a.shape[1]) / 2
    large_a, large_b = high_a > small, high_b > small
    out[np.ix_(~large_a, ~large_b)] = (a[~large_a] @ b[~large_b].T).astype(np.int64)
    out[large_a] = _by_integers(a[large_a], b)
    out[np.ix_(~large_a, large_b)] = _by_integers(a[~large_a], b[large_b])
    return out
