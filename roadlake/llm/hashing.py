"""64-bit hashes of words, word sequences and bytes, computed by numpy over Arrow text."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: White space between words; every other byte belongs to a word.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
BYTE = np.random.RandomState(5).randint(0, 1 << 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Powers:
    """Powers of BASE and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 18)
            steps = np.full(size, BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
            steps[0] = 1
            self.down = np.cumprod(steps)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of values times powers: the hash of a stretch is a difference of two."""
        self.reach(len(values))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def stretches(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of values[start:end], the same wherever the stretch stands."""
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def words(powers: Powers, data: np.ndarray, offsets: np.ndarray):
    """(hash, start, end) of each word, and for each text the number of its first word (one entry more than texts)."""
    n = len(data)
    space = SPACE[data]
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    np.logical_not(space, out=space)
    starts, ends = np.flatnonzero(space & before), np.flatnonzero(space & after) + 1
    hashes = powers.stretches(powers.sums(BYTE[data]), starts, ends)
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def runs_of(powers: Powers, hashes: np.ndarray, firsts: np.ndarray, k: int):
    """(hash, text) of every run of k consecutive words; a text with fewer words but at least one is one run."""
    counts = np.diff(firsts)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    owner = np.repeat(np.arange(len(counts)), made)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made)
    starts = firsts[:-1][owner] + place
    ends = np.minimum(starts + k, firsts[1:][owner])
    return powers.stretches(powers.sums(hashes), starts, ends), owner
