"""Polynomial prefix hashes over byte arrays, modulo 2**64 (numpy wraps)."""

from __future__ import annotations

import numpy as np

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so that each has an inverse
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, kept for the life of the worker."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 20)
        up = np.full(n, base, np.uint64)
        down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up), np.cumprod(down))
        if n <= 1 << 23:
            _tables[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class PrefixHash:
    """Hash of any substring of ``data`` from one prefix sum.

    With p[i] = sum of (data[j] + 1) * base**j for j < i, the substring of
    length n at s hashes to (p[s + n] - p[s]) * base**-s, equal for equal
    substrings wherever they stand."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        n = len(data)
        up, self._down = _powers(base, n + 1)
        self._p = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self._p[1:])

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._p[ends] - self._p[starts]) * self._down[starts]

    def grams(self, k: int) -> np.ndarray:
        """Hash of the substring of length k at every position that has one."""
        n = len(self._p) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = self._p[k:] - self._p[:n]
        out *= self._down[:n]
        return out
