"""Word shingles of whole texts as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import functools

import numpy as np

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ODD = 0x9E3779B97F4A7C15


def spread(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values; arithmetic wraps."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@functools.cache
def byte_values() -> np.ndarray:
    """A value for each byte; 0 for the bytes that part words."""
    with np.errstate(over="ignore"):
        values = spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))
    values[[0x20, *range(0x09, 0x0E)]] = 0
    return values


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as long as any text so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16, 2 * len(self.up))
            steps = np.ones((2, size), np.uint64)
            steps[0, 1:], steps[1, 1:] = ODD, pow(ODD, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up, self.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return self.up, self.down


POWERS = Powers()


def word_hashes(text: str) -> np.ndarray:
    """Hash of each word, in order; A-Z count as a-z."""
    data = np.frombuffer(text.encode().translate(LOWER), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    values = byte_values()[data]
    inside = np.concatenate([[False], values != 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = POWERS.upto(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(data)])])
        return spread((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words, ascending; a shorter text is one run; no words, no run."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = min(size, len(words))
    with np.errstate(over="ignore"):
        runs = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            runs = (runs + words[i : len(words) - n + 1 + i]) * np.uint64(ODD + 2 * i)
        return np.unique(spread(runs + np.uint64(n)))


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """The least value of the hashes under each of many permutations."""
    salts = spread(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(ODD))
    least = np.empty(coordinates, np.uint64)
    with np.errstate(over="ignore"):
        for i, salt in enumerate(salts):
            x = (hashes ^ salt) * np.uint64(0xD6E8FEB86659FD93)
            least[i] = (x ^ (x >> np.uint64(32))).min() * (salt | np.uint64(1))
    return least


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """For each set, a row of its least values under many permutations; sets must not be empty.

    All sets lie side by side, so that each permutation is one pass over them, in 32 bits. Values of different
    coordinates are kept apart by the coordinate's number in the upper half.
    """
    sizes = np.array([len(s) for s in sets])
    low = np.concatenate(sets).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    salts = spread(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(ODD))
    found = np.empty((len(sets), coordinates), np.uint64)
    with np.errstate(over="ignore"):
        for i, salt in enumerate(salts):
            x = (low ^ np.uint32(salt >> np.uint64(32))) * (np.uint32(salt & np.uint64(0xFFFFFFFF)) | np.uint32(1))
            found[:, i] = np.minimum.reduceat(x ^ x >> np.uint32(16), starts).astype(np.uint64) | np.uint64(i + 1) << np.uint64(32)
    return found
