"""Hilbert-curve keys of points in a few dimensions, on numpy arrays."""

from __future__ import annotations

import numpy as np


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of integer cells (rows) of ``bits`` bits
    per dimension: reflect and exchange axes from the highest bit down, take the
    Gray code, and interleave."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key
