"""Hilbert keys by Skilling's transform of the coordinates (AIP Conf. Proc. 707, 2004), for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Position along the curve of integer points (rows, dimensions) with ``bits`` bits each."""
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    for high in range(bits - 1, 0, -1):
        low = (1 << high) - 1
        for i in range(dims):
            set_ = x[i] >> high & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for high in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> high & 1 == 1, (1 << high) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for high in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[i] >> high & 1
    return key
