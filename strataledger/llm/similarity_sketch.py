"""Fast similarity sketching: a fixed number of coordinates whose agreement estimates Jaccard similarity.

Round ``i`` hashes every element to a bin and a value; a bin keeps its smallest value, and values of later rounds count as
larger. The first rounds choose bins at random; round ``BINS + j`` sends all elements to bin ``j``, so every
coordinate fills after at most ``2 * BINS`` rounds. Rounds end as soon as all bins are filled, which takes one or two
passes for large sets.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from strataledger.llm.shingles import U64, mix

BANDS = 24
ROWS = 6
BINS = BANDS * ROWS
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(maxsize=4)
def seeds_of(size: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 2 * size, dtype=np.uint64)


@lru_cache(maxsize=4)
def row_factors(rows: int) -> np.ndarray:
    return np.random.default_rng(8).integers(1, 1 << 63, rows, dtype=np.uint64) * U64(2) + U64(1)


def sketch(elements: np.ndarray, size: int = BINS) -> np.ndarray:
    """The ``size`` coordinates of a non-empty set of 64-bit hashes."""
    bins = np.full(size, EMPTY, np.uint64)
    own = seeds_of(size)
    # One pass places so many hashes; small sets run several rounds in a pass.
    rounds = max(1, int(1.5 * size * np.log(size)) // len(elements))
    for first in range(0, size, rounds):
        seeds = own[first : min(first + rounds, size)]
        hashes = mix(elements[None, :] ^ seeds[:, None])
        place = ((hashes >> U64(32)) * U64(size)) >> U64(32)
        value = (hashes & U64(0xFFFFFFFF)) | (np.arange(first, first + len(seeds), dtype=np.uint64) << U64(32))[:, None]
        np.minimum.at(bins, place.ravel().astype(np.int64), value.ravel())
        if bins.max() != EMPTY:
            return bins
    for j in np.flatnonzero(bins == EMPTY):
        bins[j] = (mix(elements ^ own[size + j]) & U64(0xFFFFFFFF)).min() | U64((size + int(j)) << 32)
    return bins


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key per band of ``rows`` coordinates; sets that agree in all rows of a band share its key."""
    bands = len(coordinates) // rows
    joined = (mix(coordinates).reshape(bands, rows) * row_factors(rows)).sum(axis=1)
    return mix(joined + np.arange(1, bands + 1, dtype=np.uint64) * U64(0xD1B54A32D192ED03))
