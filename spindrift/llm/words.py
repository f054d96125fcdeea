"""Words of many texts at once: bounds, 64-bit hashes and rolling hashes as numpy arrays.

A hash of a byte run is a polynomial over random byte values, taken from prefix sums modulo 2^64,
so any run of a buffer costs two lookups.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}
_MOST_POWERS = 3 << 19


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; a worker keeps at most ``_MOST_POWERS`` of a base between batches."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= _MOST_POWERS:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Hashes of runs ``[start, end)`` of a sequence of symbols with 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self._prefix[1:])
        self._back = powers(_INVERSE, n + 1)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._prefix[ends] - self._prefix[starts]) * self._back[starts]
        return mix(raw + np.asarray(ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, size: int) -> np.ndarray:
        """Hash of every full window of ``size`` symbols."""
        n = len(self._prefix) - size
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self._prefix[size:] - self._prefix[:n]) * self._back[:n])


def byte_hasher(buffer: np.ndarray) -> Hasher:
    return Hasher(_VALUES[buffer])


class Words:
    """White-space-separated words of a list of texts (bytes), in order."""

    def __init__(self, texts: list[bytes]):
        self.joined = b"\n".join(texts) + b"\n"
        self.buffer = np.frombuffer(self.joined, dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_ends = np.cumsum(lengths + 1) - 1
        self.text_starts = self.text_ends - lengths
        space = _SPACE[self.buffer]
        change = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            change = np.concatenate(([0], change))
        self.starts, self.ends = change[0::2], change[1::2]
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.counts = np.searchsorted(self.starts, self.text_ends) - self.first
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        return byte_hasher(self.buffer).runs(self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.joined[self.starts[i]:self.ends[i]]


def ragged(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices ``begin, begin + 1, ...`` of all runs, one run after another."""
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins - (upto - sizes), sizes)


def sums_per_text(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each text's run of ``values``."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first + counts] - total[first]


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every full window of ``size`` values, by doubling."""
    have, span = values, 1
    while span * 2 <= size:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = size - span
    return np.minimum(have[:-rest], have[rest:]) if rest else have


def minimisers(hashes: np.ndarray, size: int) -> np.ndarray:
    """Positions whose hash is the least of some window of ``size`` hashes; every tie counts."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.int64)
    least = sliding_minimum(hashes, size)
    top = np.iinfo(hashes.dtype).max
    padded = np.concatenate((np.zeros(size - 1, hashes.dtype), least, np.zeros(size - 1, hashes.dtype)))
    highest = top - sliding_minimum(top - padded, size)
    return np.flatnonzero((highest == hashes) & (hashes != top))
