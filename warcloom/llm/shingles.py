"""Shingle sets as sorted 64-bit hashes, and their one-permutation MinHash signatures.

The range of hashes is cut into bins; a bin's value is the smallest hash in it. An empty
bin takes the value of another one, found by a fixed random sequence of its own (optimal
densification), so two sets agree in a bin with a probability equal to their similarity.
Bands of bins make the keys of the buckets in which similar sets meet.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import xxhash

#: Bytes A to Z in lower case.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ODD = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 100_000
PROBES = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Words of texts (runs without ASCII white space, A to Z lowered) as hashes."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def hashes(self, texts: list[str]) -> list[np.ndarray]:
        cut = [t.encode("utf-8", "surrogatepass").translate(LOWER).split() for t in texts]
        sizes = [len(c) for c in cut]
        every = itertools.chain.from_iterable(cut)
        flat = np.fromiter(map(self.__getitem__, every), dtype=np.uint64, count=sum(sizes))
        if len(self) > CACHED_WORDS:
            self.clear()
        ends = np.cumsum(sizes)
        return [flat[b - n : b] for n, b in zip(sizes, ends)]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of ``size`` words, sorted; of fewer words, all as one shingle."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    joined = words[: n - size + 1].copy()
    for k in range(1, size):
        joined = mixed(joined * ODD + np.uint64(k)) + words[k : n - size + 1 + k]
    # Shorter sequences are no shingles of the usual size.
    return np.unique(mixed(joined + np.uint64(size)))


def node_of(shingles: np.ndarray) -> bytes:
    """What stands for a set: equal sets have equal ones."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class Bands:
    """Bucket keys of sets: ``bands`` bands of ``rows`` bins."""

    def __init__(self, bands: int, rows: int, seed: int = 11) -> None:
        self.bands, self.rows = bands, rows
        bins = bands * rows
        rng = np.random.default_rng(seed)
        self.edges = np.array([-(-(i << 64) // bins) for i in range(bins)], dtype=np.uint64)
        self.probes = rng.integers(0, bins, (bins, PROBES))
        # Where the probes meet no full bin, all bins follow in an order of each bin's own.
        self.ranks = np.argsort(np.random.default_rng(seed + 1).random((bins, bins)), axis=1).argsort(axis=1)
        self.scale = rng.integers(1, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = mixed(np.arange(1, bands + 1, dtype=np.uint64) * ODD)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        first = np.searchsorted(shingles, self.edges)
        after = np.append(first[1:], len(shingles))
        full = first < after
        value = shingles[np.minimum(first, len(shingles) - 1)]
        empty = np.nonzero(~full)[0]
        if len(empty):
            left = empty
            for t in range(PROBES):
                donor = self.probes[left, t]
                found = full[donor]
                value[left[found]] = value[donor[found]]
                left = left[~found]
                if not len(left):
                    break
            if len(left):
                donors = np.nonzero(full)[0]
                value[left] = value[donors[self.ranks[np.ix_(left, donors)].argmin(axis=1)]]
        return value

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """A key for each band, as signed 64-bit numbers."""
        rows = self.signature(shingles).reshape(self.bands, self.rows)
        return mixed((mixed(rows) * self.scale).sum(axis=1, dtype=np.uint64) + self.salt).view(np.int64)


def held(some: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which members of a sorted set are in another one."""
    if not len(other):
        return np.zeros(len(some), dtype=bool)
    at = np.searchsorted(other, some)
    return other[np.minimum(at, len(other) - 1)] == some
