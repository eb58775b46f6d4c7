"""Vectorised hashing of the words of UTF-8 texts."""

from __future__ import annotations

import numpy as np

_PLACES = 1 << 16
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# One random factor per byte value and per place in the word (places repeat far beyond any real word).
_OF_BYTE = scramble(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_OF_PLACE = scramble(np.arange(1001, 1001 + _PLACES, dtype=np.uint64) * _GOLDEN) | np.uint64(1)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of true values."""
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def hash_segments(packed: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the consecutive byte segments of ``packed``; the empty segment's hash is 0."""
    ends = np.cumsum(lengths)
    place = np.arange(len(packed)) - np.repeat(ends - lengths, lengths)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[packed] * _OF_PLACE[place & (_PLACES - 1)])])
    return scramble(total[ends] - total[ends - lengths])


def combine(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return scramble((a ^ (a >> np.uint64(32))) * _GOLDEN + np.asarray(b, np.uint64))
