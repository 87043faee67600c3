"""Words, lines and their 64-bit hashes of many texts at once, on UTF-8 bytes, in numpy.

Words are maximal runs of bytes other than space and \\t..\\r; all separators are ASCII, so bytes suffice.
A slice's hash is a difference of prefix sums of a polynomial over mixed byte values, modulo 2**64, mixed again.
"""

from __future__ import annotations

import numpy as np

_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_P = 0xD1342543DE82EF95
_IP = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x + _G
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, p in enumerate((_P, _IP)):
            out = np.full(max(n, 1 << 20), np.uint64(p), np.uint64)
            out[0] = 1
            _powers[k] = np.cumprod(out, dtype=np.uint64)
    powers = _powers[0], _powers[1]
    if n > 1 << 23:  # one huge text: its tables are not kept
        _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    return powers


class Slices:
    """Hashes of slices of one chunk of bytes."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[: len(data)], out=self._sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mix(raw ^ ((end - start).astype(np.uint64) * _G))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk, and the index of each word's text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    return start, end, np.searchsorted(offsets, start, "right") - 1


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the \\n-split lines of the non-empty texts of a chunk, and the index of each line's text."""
    breaks = np.flatnonzero(data == 10)
    full = np.flatnonzero(np.diff(offsets) > 0)
    start = np.concatenate([offsets[full], breaks + 1])
    owner = np.concatenate([full, np.searchsorted(offsets, breaks, "right") - 1])
    end = np.concatenate([breaks, offsets[full + 1]])
    end_owner = np.concatenate([owner[len(full) :], full])
    a, b = np.lexsort((start, owner)), np.lexsort((end, end_owner))
    return start[a], end[b], owner[a]


def windows(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``size`` words that lie in one text, and the index of each window's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = mix(out * _M1 + hashes[at + k])
    return out, at
