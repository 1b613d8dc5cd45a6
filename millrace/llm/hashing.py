"""Hashes of words, shingles and byte windows, a few array operations per megabyte of text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_GAP = re.compile(rb"[\x20\x09-\x0D]")
SEGMENT = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others (the finishing step of a splitmix generator, in place)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=8)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=8)
def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    base = int(np.random.default_rng(seed + 1).integers(2**40, 2**62)) * 8 + 5
    out = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(n, b & (2**64 - 1), np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Rolling:
    """Hashes of any pieces of a byte array: a sum of byte values times powers of the place, shifted back to the start."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        size = 1 << max(16, len(data).bit_length())
        up, self._down = _powers(seed, size)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values(seed)[data] * up[: len(data)], out=self._sums[1:])

    def pieces(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mixed(h ^ ((ends - starts).astype(np.uint64) * _MIX))


def _segments(data: bytes) -> Iterator[bytes]:
    """Pieces of about SEGMENT bytes, cut between words."""
    at = 0
    while at < len(data):
        cut = _GAP.search(data, at + SEGMENT)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """A hash per word, in order; words are what stands between spaces and the control characters 9 to 13."""
    found = []
    for piece in _segments(data):
        buf = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(buf) + 2, bool)
        inside[1:-1] = (buf != 32) & ((buf < 9) | (buf > 13))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges):
            found.append(Rolling(buf).pieces(edges[::2], edges[1::2]))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; of all words together when there are fewer; none without words."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = words[:n].copy()
    for k in range(1, size):
        h = mixed(h * _MIX + words[k : k + n])
    return np.unique(h)
