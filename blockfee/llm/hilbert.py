"""Places of points along Hilbert curves, for arrays of points."""

from __future__ import annotations

import numpy as np


def hilbert_order(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point along the curve; a row of ``points`` is a point with coordinates below 2**bits.

    The curve is followed from the coarsest cells to the finest: each level's cell is read
    in the orientation that the levels above leave, as a Gray code. Coordinates times bits
    must fit in 63 bits.
    """
    n, dims = points.shape
    x = points.astype(np.int64).copy()
    # Undo the turns of each level, from coarse to fine.
    for level in range(bits - 1, 0, -1):
        cell = np.int64(1) << level
        below = cell - 1
        for i in range(dims):
            turned = (x[:, i] & cell) != 0
            swapped = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & below)
            x[:, 0] = np.where(turned, x[:, 0] ^ below, x[:, 0] ^ swapped)
            x[:, i] ^= swapped
    # Gray code of the coordinates' bits, most significant level first.
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flips = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        cell = np.int64(1) << level
        flips = np.where((x[:, dims - 1] & cell) != 0, flips ^ (cell - 1), flips)
    x ^= flips[:, None]
    place = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << 1) | ((x[:, i] >> level) & 1)
    return place
