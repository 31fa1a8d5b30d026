"""Interval joins against plain comparison, digest trees against whole comparison."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strataledger.operators import digest_tree
from strataledger.operators.intervals import days_in_intervals

DAY = dt.date(1969, 12, 20)  # days on both sides of the calendar's zero


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def made(seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", "c", None]), day(rng.choice([None, *range(60)]))) for i in range(150)]
    intervals = []
    for i in range(60):
        start = rng.randrange(50)
        length = rng.choice([0, 0, 1, 2, 3, 7, 8, 31, 400, -3])
        intervals.append((i, rng.choice(["a", "b", "c", None]), day(rng.choice([start, start, start, None])), day(start + length)))
    return rows, intervals + [(99, "a", day(1), None)]


@pytest.mark.parametrize("seed, on", [(1, ["k"]), (2, ["k"]), (3, [])])
def test_interval_join_equals_plain_comparison(spark, seed, on):
    rows, intervals = made(seed)
    left = spark.createDataFrame(rows, "id int, k string, d date")
    right = spark.createDataFrame(intervals, "n int, k string, s date, e date")
    right = right if on else right.withColumnRenamed("k", "k2")
    joined = days_in_intervals(left, "d", right, "s", "e", on=on)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    found = sorted((r["id"], r["n"]) for r in joined.collect())
    want = sorted(
        (i, n)
        for i, k, d in rows
        for n, k2, s, e in intervals
        if d and s and e and s <= d <= e and (not on or (k is not None and k == k2))
    )
    assert found == want and want


def test_interval_join_of_nothing(spark):
    left = spark.createDataFrame([(1, day(1))], "id int, d date")
    right = spark.createDataFrame([(1, day(5), day(2))], "n int, s date, e date")
    assert days_in_intervals(left, "d", right, "s", "e").count() == 0


def test_an_interval_falls_into_two_bins_at_most(spark):
    right = spark.createDataFrame([(n, day(n % 50), day(n % 50 + n)) for n in range(1000)], "n int, s date, e date")
    left = spark.createDataFrame([(1, day(5))], "id int, d date")
    length = F.datediff("e", "s") + 1
    level = F.ceil(F.log2(length.cast("double")))
    bins = right.select((F.floor(F.unix_date("e") / F.pow(F.lit(2.0), level)) - F.floor(F.unix_date("s") / F.pow(F.lit(2.0), level))).alias("x"))
    assert bins.agg(F.max("x")).first()[0] <= 1
    assert days_in_intervals(left, "d", right, "s", "e").count() == sum(n % 50 <= 5 <= n % 50 + n for n in range(1000))


def changes(spark, old, new):
    kind = "id string, v string, date date"
    rows = [digest_tree.digested(spark.createDataFrame(version, kind), ["id"], ["v"], buckets=4) for version in (old, new)]
    dates, branches = digest_tree.differing_branches(*(digest_tree.leaves(r) for r in rows))
    found = digest_tree.changed_rows(*rows, ["id"], dates, branches)
    return sorted(dates), branches, {(r["id"], r["change"]) for r in found.collect()}


def test_only_differing_branches_are_opened(spark):
    old = [(f"i{n}", f"v{n}", day(n % 10)) for n in range(200)]
    new = [row for row in old if row[0] != "i13"]
    new[new.index(("i24", "v24", day(4)))] = ("i24", None, day(4))
    new += [("new", "x", day(4)), (None, "y", day(30)), ("i7", "v7", day(7))]  # the last one repeats a row
    dates, branches, found = changes(spark, old, new)
    assert dates == [day(3), day(4), day(7), day(30)]
    assert 4 <= branches.count() <= 5
    assert found == {("i13", "removed"), ("i24", "changed"), ("new", "added"), (None, "added"), ("i7", "added")}


def test_equal_versions_open_nothing(spark):
    rows = [(f"i{n}", None if n % 3 else "", day(n % 4)) for n in range(50)]
    dates, branches, found = changes(spark, rows, list(reversed(rows)))
    assert dates == [] and branches.count() == 0 and found == set()


def test_digests_tell_fields_and_nulls_apart(spark):
    for a, b in (([("a", "bc")], [("ab", "c")]), ([("a", None)], [("a", "")]), ([("a", "-")], [("a", None)])):
        one, two = ([(*row, day(0)) for row in version] for version in (a, b))
        assert changes(spark, one, two)[2]
