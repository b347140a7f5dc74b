"""Hashes of words and of spans of words over a flat buffer, in numpy."""

from __future__ import annotations

import functools

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return tuple(
        np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]).cumprod(dtype=np.uint64)
        for base in (_BASE, inverse)
    )


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, the same wherever the span stands."""
    size = 1 << max(16, int(len(flat)).bit_length())
    power, inverse = _powers(size)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[: len(flat)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_spans(flat: np.ndarray, space: int = 0x20) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no space."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], flat == space, [True]])))
    return edges[::2], edges[1::2]


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive word hashes; other lengths hash differently."""
    count = max(0, len(words) - k + 1)
    made = np.full(count, np.uint64(k))
    for i in range(k):
        made = made * _BASE + words[i : i + count]
    return mix(made)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order: its neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank
