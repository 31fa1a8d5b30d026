import math
import random

import pytest
from pyspark.sql import functions as F

from strataledger.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string"


def brute(rows):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    found = []
    for anchor_id, anchor_label, a in kept:
        if anchor_id is None or anchor_id % 10:
            continue
        others = [(-sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in kept if i != anchor_id]
        others.sort()
        positives = [(s, i) for s, i, label in others if label == anchor_label][:5]
        for p, positive_id in positives:
            fit = [(-s, i) for s, i, label in others if label != anchor_label and -80 * p <= -100 * s <= -100 * p]
            found += [(anchor_id, positive_id, r, i, -p, s) for r, (s, i) in enumerate(fit[:5], 1)]
    return sorted(found)


def mine(spark, rows, **sizes):
    full = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(3)
    kept = hn.participating(full, F.col("label"))
    return sorted(tuple(r) for r in hn.mined(kept, F.col("vec_id") % 10 == 0, **sizes).collect())


def made(n, seed, width=6, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]
    copy = rows[7][1]
    # A group of copies that holds a third of the rows.
    return rows + [(1000 + i, list(copy), rng.randrange(labels)) for i in range(n // 2)]


@pytest.mark.parametrize("sizes", [{}, {"cells": 4, "block_numbers": 100}])
def test_equals_all_pairs(spark, sizes):
    rows = made(160, 3)
    want = brute(rows)
    assert len(want) > 300 and mine(spark, rows, **sizes) == want


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 0),
        (1, [1.0, 2.0], 0),
        (2, [1.0, 1.9], 1),
        (3, [float("nan"), 1.0], 1),
        (4, [float("inf"), 1.0], 1),
        (5, None, 1),
        (6, [None, 1.0], 1),
        (7, [1.0, 1.0], None),
        (8, [], 1),
        (9, [1.0, 1.9, 5.0], 1),
        (10, [], 2),
        (11, [], 2),
        (20, [-1.0, 0.0], 5),
        (21, [1.0, 0.0], 5),
        (30, [0.9, 2.0], 1),
        (2, [1.0, 1.9], 1),  # repeated row
        (30, [0.5, 0.5], 0),  # the same id with another vector
    ]
    # Ties of equal rows have equal columns, so sorted results are comparable.
    assert mine(spark, rows) == brute(rows)


def test_rows_without_id_take_part(spark):
    got = mine(spark, [(0, [1.0], 0), (10, [1.0], 0), (None, [1.0], 1)])
    assert got == [(0, 10, 1, None, 65536, 65536), (10, 0, 1, None, 65536, 65536)]


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 3.0], 0), (1, [1e6, 2.0], 0), (2, [1e6 - 1, 1.0], 1), (3, [1e6, 1.5], 1), (4, [1e300, 1.0], 1)]
    want = brute(rows[:4])
    assert want and mine(spark, rows) == want


def test_tables_without_anchors(spark):
    assert mine(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == [] and mine(spark, [(0, None, 1)]) == []
