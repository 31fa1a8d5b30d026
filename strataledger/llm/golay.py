"""The binary Golay code of length 23, turned round: 23-bit words map to the indices of codewords near them.

The code is perfect: every word lies within 3 bits of exactly one codeword. Its remainder modulo the generator
polynomial tells the error patterns that lead to codewords, so tables have one row per remainder and are built
from the polynomial. A codeword's upper 12 bits are its index.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH = 23
CHECKS = 11
# Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def remainders(words: np.ndarray) -> np.ndarray:
    """Remainder of each word's polynomial."""
    left = words.astype(np.int64, copy=True)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        left ^= ((left >> bit) & 1) * (GENERATOR << (bit - CHECKS))
    return left


@lru_cache(maxsize=4)
def patterns(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Per remainder the error patterns of at most ``radius`` bits, the lightest first, and their number."""
    errors = np.array([sum(1 << bit for bit in bits) for n in range(radius + 1) for bits in combinations(range(LENGTH), n)])
    left = remainders(errors)
    order = np.argsort(left, kind="stable")
    counts = np.bincount(left, minlength=1 << CHECKS)
    table = np.zeros((1 << CHECKS, counts.max()), np.int64)
    column = np.arange(len(errors)) - np.repeat(np.cumsum(counts) - counts, counts)
    table[left[order], column] = errors[order]
    return table, counts


def nearest(words: np.ndarray) -> np.ndarray:
    """Index of the codeword within 3 bits of each word."""
    return (words ^ patterns(3)[0][remainders(words), 0]) >> CHECKS


def near(words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of ``words`` and indices of all codewords within ``radius`` bits of them, the nearest first."""
    table, counts = patterns(radius)
    left = remainders(words)
    held = np.arange(table.shape[1]) < counts[left][:, None]
    indices = (words[:, None] ^ table[left]) >> CHECKS
    return np.nonzero(held)[0], indices[held]
