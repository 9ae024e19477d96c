"""64-bit hashes of all words of many texts at once.

Hash of a word: sum of T[byte] * B**place modulo 2**64, taken from prefix sums over the whole buffer and
moved to place 0 by the inverse power, then mixed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_TABLE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)

#: Bytes whose mixed values are held at once.
SLICE = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end]."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(max(1 << 16, 1 << int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def placed_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end], none of them empty, in order and apart: each byte is mixed with its place before the sum.

    Unlike a polynomial modulo 2**64, this has no words that agree whatever the constants. Works in slices of ``SLICE`` bytes.
    """
    lengths = ends - starts
    sums, after = np.zeros(len(starts), np.uint64), np.cumsum(lengths)
    total = int(after[-1]) if len(after) else 0
    for low in range(0, total, SLICE):
        high = min(low + SLICE, total)
        a, b = np.searchsorted(after, [low, high - 1], "right")
        before = after[a : b + 1] - lengths[a : b + 1]
        firsts = np.maximum(before, low) - low
        counts = np.minimum(after[a : b + 1], high) - low - firsts
        place = np.arange(low, high) - np.repeat(before, counts)
        byte = data[place + np.repeat(starts[a : b + 1], counts)]
        value = mixed(((place.astype(np.uint64) << np.uint64(8)) | byte) * np.uint64(_BASE) + _TABLE[0])
        sums[a : b + 1] += np.add.reduceat(value, firsts)
    return mixed(sums + lengths.astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text (with one more entry at the end)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~SPACES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = bounds[:-1][bounds[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    finishes[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, bounds)
