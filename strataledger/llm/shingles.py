"""Word shingles of texts as 64-bit hashes, in numpy over blocks of texts.

Words are runs of bytes other than ASCII white space, after lower-casing A-Z. A word's hash is a polynomial
of random byte values modulo 2**64, taken from prefix sums over the block; shingle hashes combine word hashes
by place. Two different shingles of one corpus meet with probability 2**-64 each.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
PLACES = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) * U64(2) + U64(1)
BYTE_VALUES[[9, 10, 11, 12, 13, 32]] = 0  # white space


def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit changes every output bit."""
    values = (values ^ (values >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U64(27))) * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


@lru_cache(maxsize=2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(size, BASE, np.uint64))
        down = np.cumprod(np.full(size, pow(BASE, -1, 1 << 64), np.uint64))
    return up, down


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words up to the end of each text."""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    values = BYTE_VALUES[data]
    solid = np.concatenate([[False], values != 0, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(16, int(len(data) - 1).bit_length())
    up, down = powers(size)
    sums = np.concatenate([[U64(0)], np.cumsum(values * up[: len(data)])])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    stops = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, stops)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text; with fewer words than a shingle, the whole sequence is one."""
    hashes, stops = word_hashes(texts)
    if len(hashes) >= WORDS:
        n = len(hashes) - WORDS + 1
        joined = sum(hashes[place : place + n] * PLACES[place] for place in range(WORDS))
        joined = mix(joined)
    sets, start = [], 0
    for stop in stops:
        if stop - start >= WORDS:
            sets.append(np.unique(joined[start : stop - WORDS + 1]))
        elif stop > start:
            few = hashes[start:stop]
            sets.append(mix((few * PLACES[: len(few)]).sum(keepdims=True) + U64(len(few))))
        else:
            sets.append(np.zeros(0, np.uint64))
        start = stop
    return sets
