"""Word shingles and their one-permutation sketches, vectorised over a text's bytes."""

from __future__ import annotations

import re

import numpy as np

#: Fixed seeds: values must agree between workers and runs.
_RNG = np.random.Generator(np.random.PCG64(20240607))
_U64 = np.uint64
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
WIDTH = 5
_PLACES = _RNG.integers(1, 2**63, WIDTH, dtype=np.uint64) * _U64(2) + _U64(1)
CHUNK = 1 << 22
_AFTER = re.compile(rb"[\x20\x09-\x0d]")
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 17)
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate([[_U64(1)], np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, _BACK)]
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads each bit over all (the finaliser of SplitMix64)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _words(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[b], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(b) + 1)
    total = np.concatenate([[_U64(0)], np.cumsum(_BYTE[b] * up[: len(b)], dtype=np.uint64)])
    start, end = edges[::2], edges[1::2]
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash for each word, in order; long texts go in chunks cut at white space."""
    if len(data) <= CHUNK:
        return _words(data)
    out, at = [], 0
    while at < len(data):
        m = _AFTER.search(data, at + CHUNK)
        end = m.start() if m else len(data)
        out.append(_words(data[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; the whole text as one if it has fewer words."""
    w = word_hashes(text.encode("utf-8", "surrogatepass"))
    if not len(w):
        return w
    if len(w) < WIDTH:
        return mixed(np.array([(w * _PLACES[: len(w)]).sum(dtype=np.uint64) + _U64(len(w))]))
    n = len(w) - WIDTH + 1
    h = w[:n] * _PLACES[0]
    for k in range(1, WIDTH):
        h += w[k : k + n] * _PLACES[k]
    h = mixed(h)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


class OnePermutation:
    """One hash of each shingle falls in one of bins; a bin keeps its least.

    Optimal densification: an empty bin looks at bins drawn by its own fixed random sequence and copies
    the first that isn't empty, so each bin agrees between two sets with the probability of their similarity.
    """

    def __init__(self, bands: int = 32, rows: int = 6, seed: int = 7):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.Generator(np.random.PCG64(seed))
        self.look = rng.integers(0, self.bins, (self.bins, 4096), dtype=np.int16)
        self.place = rng.integers(1, 2**63, (bands, rows), dtype=np.uint64) * _U64(2) + _U64(1)
        self.band = rng.integers(1, 2**63, bands, dtype=np.uint64)
        self.numbers = np.arange(self.bins, dtype=np.uint64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """hashes: sorted, distinct, at least one."""
        bins = ((hashes >> _U64(32)) * _U64(self.bins)) >> _U64(32)
        first = np.searchsorted(bins, self.numbers)
        full = bins[np.minimum(first, len(bins) - 1)] == self.numbers
        out = hashes[np.minimum(first, len(bins) - 1)]
        empty = np.flatnonzero(~full)
        for width in (64, self.look.shape[1]):
            if not len(empty):
                break
            seen = full[self.look[empty, :width]]
            hit, at = seen.any(axis=1), seen.argmax(axis=1)
            out[empty[hit]] = out[self.look[empty[hit], at[hit]]]
            empty = empty[~hit]
        out[empty] = out[np.flatnonzero(full)[0]]
        return out

    def keys(self, signature: np.ndarray) -> np.ndarray:
        """One 64-bit bucket key for each band."""
        return mixed((signature.reshape(self.bands, self.rows) * self.place).sum(axis=1, dtype=np.uint64) + self.band)

    def sketch(self, signature: np.ndarray) -> bytes:
        """One byte for each bin."""
        return (signature * _U64(0xD6E8FEB86659FD93) >> _U64(56)).astype(np.uint8).tobytes()
