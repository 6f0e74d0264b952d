"""Hashes of stretches of a byte string, a piece at a time."""

from __future__ import annotations

from functools import cache

import numpy as np

ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def row_key(*columns: np.ndarray) -> np.ndarray:
    """One hash of several columns, to tell rows of one piece or task apart."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mixed((out ^ c.astype(np.uint64, copy=False)) * ODD[1] + ODD[0])
    return out


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(ODD[base]), -1, 1 << 64))
    up, down = np.full(size, ODD[base], np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hasher:
    """Hashes of any stretch of one byte string, from sums over its prefixes."""

    def __init__(self, raw: np.ndarray, base: int = 0):
        size = 1 << max(16, int(len(raw) + 1).bit_length())
        up, self.down = _powers(base, size)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(0x1F3)) * up[: len(raw)], out=self.sums[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])
