"""Exact cyclic convolution of rows of whole numbers, by number-theoretic transforms."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: 15 * 2**27 + 1, a prime with roots of one of every order up to 2**27; 31 is a generator.
MODULUS = 2013265921
GENERATOR = 31
LARGEST = 1 << 27
_P = np.uint64(MODULUS)


@lru_cache(maxsize=64)
def _twiddles(size: int, inverse: bool) -> np.ndarray:
    """The powers 0 to size/2 - 1 of a root of one of order ``size``, or of its inverse."""
    root = pow(GENERATOR, (MODULUS - 1) // size, MODULUS)
    root = pow(root, MODULUS - 2, MODULUS) if inverse else root
    powers = np.ones(max(1, size // 2), np.uint64)
    filled = 1
    while filled < len(powers):
        step = np.uint64(pow(root, filled, MODULUS))
        powers[filled : 2 * filled] = powers[:filled] * step % _P
        filled *= 2
    return powers


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below twice the modulus, reduced: a number that is too small already wraps to a large one."""
    return np.minimum(x, x - _P)


def _forward(rows: np.ndarray) -> np.ndarray:
    """Transform of each row; the places of the result are in bit-reversed order."""
    count, size = rows.shape
    half = size // 2
    x = rows
    while half:
        x = x.reshape(-1, 2, half)
        sums = _reduced(x[:, 0] + x[:, 1])
        differences = (x[:, 0] + _P - x[:, 1]) * _twiddles(2 * half, False) % _P
        x = np.stack((sums, differences), axis=1)
        half //= 2
    return x.reshape(count, size)


def _backward(rows: np.ndarray) -> np.ndarray:
    """The inverse of ``_forward``, times the size."""
    count, size = rows.shape
    half = 1
    x = rows
    while half < size:
        x = x.reshape(-1, 2, half)
        turned = x[:, 1] * _twiddles(2 * half, True) % _P
        x = np.stack((_reduced(x[:, 0] + turned), _reduced(x[:, 0] + _P - turned)), axis=1)
        half *= 2
    return x.reshape(count, size)


def convolved(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cyclic convolution of each row of ``one`` with that of ``two``, modulo ``MODULUS``.

    Rows are unsigned 64-bit numbers below the modulus; their length is a power of two.
    """
    size = one.shape[1]
    product = _forward(one) * _forward(two) % _P
    return _backward(product) * np.uint64(pow(size, MODULUS - 2, MODULUS)) % _P
