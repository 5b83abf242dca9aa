"""Hashes of words and of runs of words, worked out for many documents at once.

Words are maximal runs of bytes other than space and ``\\t`` to ``\\r``. A word's
hash is a polynomial over random 64-bit byte codes, read off a running sum, so
no Python loop runs over words. A run of words is hashed the same way over the
words' hashes, twice with different multipliers: 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Text bytes worked on at once; a longer document is taken alone.
CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C1D)  # 5 modulo 8: few trailing zeros in its powers less one
_RUN_BASES = (np.uint64(0xC2B2AE3D27D4EB4D), np.uint64(0x165667B19E3779F5))
_MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_CODES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base and of its inverse, modulo 2**64."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) <= n:
        size = max(n + 1, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        columns = []
        for b in (base, inverse):
            column = np.full(size, b, np.uint64)
            column[0] = 1
            columns.append(np.multiply.accumulate(column))
        known = (columns[0], columns[1])
        if size <= 4 * CHUNK_BYTES:  # a giant document's tables are not kept
            _POWERS[int(base)] = known
    return known


def mix(h: np.ndarray, multiplier: np.uint64) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * multiplier
    h = (h ^ (h >> np.uint64(27))) * _MIXERS[1]
    return h ^ (h >> np.uint64(31))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words among bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _powers(_BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts], _MIXERS[0])


def run_hashes(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every run of ``length`` consecutive words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    out = []
    for base, mixer in zip(_RUN_BASES, _MIXERS):
        powers, inverse = _powers(base, len(words))
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix(words, mixer) * powers[: len(words)], out=sums[1:])
        out.append(mix((sums[length:] - sums[:n]) * inverse[:n], mixer))
    return out[0], out[1]


def lead_hashes(words: np.ndarray, length: int, lead: int = 5) -> np.ndarray:
    """For every run of ``length`` words the smallest hash of a shorter run inside it.

    Neighbouring runs mostly share it, equal runs always do.
    """
    lead = min(lead, length)
    least, size, width = run_hashes(words, lead)[0], 1, length - lead + 1
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return mix(np.minimum(least[:n], least[width - size : width - size + n]), _MIXERS[0])


class Words:
    """The words of some documents: offsets, hashes, and each document's first word."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join(texts), np.uint8)
        self.starts, self.ends = words_of(self.data)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = word_hashes(self.data, self.starts, self.ends)

    def windows(self, length: int) -> tuple[np.ndarray, ...]:
        """(document, first word in it, hash, second hash, lead) of every window inside a document."""
        h1, h2 = run_hashes(self.hashes, length)
        counts = np.diff(self.first)
        doc = np.repeat(np.arange(len(counts)), counts)
        inside = np.flatnonzero(doc[: len(h1)] == doc[length - 1 :]) if len(h1) else np.empty(0, np.int64)
        own = doc[inside]
        leads = lead_hashes(self.hashes, length)
        return own, inside - self.first[own], h1[inside], h2[inside], leads[inside]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes in all."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)
