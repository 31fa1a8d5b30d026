"""Random feeds against a plain walk over the days."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_rules import bronze, codes, row

from strataledger import schemas
from strataledger.operators import checks, joins
from strataledger.operators import daily as dly
from strataledger.operators import transactions as txn
from strataledger.sources.files import local_frame

START = dt.date(2024, 1, 1)


def random_rows(seed, days=6, per_day=14, ids=12):
    rng = random.Random(seed)
    rows, tag = [], 0
    for d in range(days):
        date = START + dt.timedelta(days=d)
        for _ in range(rng.randrange(per_day)):
            # One id takes about a third of all rows.
            id_ = "HOT" if rng.random() < 0.33 else rng.choice([None, "", *[f"T{i}" for i in range(ids)]])
            tag += 1
            rows.append(
                row(
                    id_,
                    account=rng.choice(["A", "B", "HOT", None]),
                    amount=rng.choice(["5.00", "0.00", "7.25", None]) if rng.random() < 0.4 else "5.00",
                    code=rng.choice(["P", "C", "??"]) if rng.random() < 0.6 else "P",
                    channel=rng.choice(["ONLINE", "IN_STORE", "FAX"]),
                    file=date,
                    tag=tag,
                )
            )
    return rows


def walk(rows, scope, history=()):
    """Day by day: each file against the ids accepted on other dates (and earlier in the file)."""
    accepted, reasons = set(history), {}
    for date in sorted({r[10] for r in rows}):
        today = set()
        for r in sorted((r for r in rows if r[10] == date), key=lambda r: r[11]):
            id_, account, tdate, amount, code, _, channel = r[:7]
            seen = accepted | today if scope == txn.SCOPE_BATCH else accepted
            if not id_ or not account or tdate is None or amount is None or not code or not channel:
                reason = "NULL_REQUIRED_FIELD"
            elif amount <= 0:
                reason = "INVALID_AMOUNT"
            elif id_ in seen:
                reason = "DUPLICATE_TRANSACTION_ID"
            elif code not in ("P", "C", "Z"):
                reason = "INVALID_TRANSACTION_CODE"
            elif channel not in ("ONLINE", "IN_STORE"):
                reason = "INVALID_CHANNEL"
            else:
                reason = None
                today.add(id_)
            reasons[r[11]] = reason
        accepted |= today
    return reasons


@pytest.mark.parametrize("scope", [txn.SCOPE_HISTORY, txn.SCOPE_BATCH])
def test_set_based_rule_equals_the_walk(spark, scope):
    """Many feeds in one job: ids are prefixed with the seed, so feeds do not meet."""
    rows, expected = [], {}
    for seed in range(60):
        base = seed * 10_000
        feed = random_rows(seed)
        for tag, reason in walk(feed, scope).items():
            expected[base + tag] = reason
        for r in feed:
            id_ = f"{seed}-{r[0]}" if r[0] else r[0]
            rows.append((id_, *r[1:11], base + r[11]))
    got = {r._row_tag: r._rejection_reason for r in txn.classify(bronze(spark, rows), codes(spark), None, scope).collect()}
    assert got == expected
    assert len(Counter(expected.values())) == 6


@pytest.mark.parametrize("scope", [txn.SCOPE_HISTORY, txn.SCOPE_BATCH])
def test_later_days_against_stored_history(spark, scope):
    rows = random_rows(7, days=8, per_day=40)
    cut = START + dt.timedelta(days=4)
    full = walk(rows, scope)
    kept = [(r[0],) for r in rows if r[10] < cut and full[r[11]] is None]
    history = local_frame(spark, kept, schemas._schema(("transaction_id", schemas.S)))
    later = [r for r in rows if r[10] >= cut]
    got = {r._row_tag: r._rejection_reason for r in txn.classify(bronze(spark, later), codes(spark), history, scope).collect()}
    assert got == {tag: full[tag] for tag in got} and len(got) == len(later)


def test_accounting_and_daily_totals(spark):
    rows = random_rows(3, per_day=60)
    seen = local_frame(spark, [("A", START), ("HOT", START + dt.timedelta(days=2))],
                       schemas._schema(("account_id", schemas.S), ("_first_seen_date", schemas.D)))
    frame = bronze(spark, rows)
    resolved = txn.resolve(txn.classify(frame, codes(spark)), seen)
    silver, rejects = txn.accepted(resolved, "r"), txn.rejected(resolved, "r")
    total = checks.accounting_total(checks.accounting_by_date(frame, silver, rejects)).first()
    assert (total.bronze_rows, total.discrepancy) == (len(rows), 0)
    summary = dly.daily_summary(silver, codes(spark))
    partials = dly.daily_partials(silver, codes(spark), by=("date", "transaction_date"))
    added = dly.flat_daily(dly.dense_days(dly.added_days(partials))).select(*summary.columns)
    assert {tuple(r) for r in added.collect()} == {tuple(r) for r in summary.collect()}
    for r in silver.collect():
        known = {"A": START, "HOT": START + dt.timedelta(days=2)}.get(r.account_id)
        assert r._is_resolvable == (known is not None and known <= r.date)


def test_latest_per_key_with_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 50)).alias("key"),
        (F.col("id") % 7).alias("day"),
        "id",
    )
    got = {r.key: (r.day, r.id) for r in joins.latest_per_key(rows, ["key"], ["day"]).collect()}
    expected = {}
    for r in rows.collect():
        expected[r.key] = max(expected.get(r.key, (-1, -1)), (r.day, r.id))
    assert got == expected


def test_rows_at_greatest_with_a_hot_key(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int"))
    key = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 50 > 0, F.concat(F.lit("K"), F.col("id") % 50))
    rows = spark.range(3000).select(key.alias("key"), day.alias("day"), F.col("id").cast("decimal(27,0)").alias("place"), F.lit("x").alias("name"))
    rows = rows.union(rows)
    found = joins.rows_at_greatest(rows, "key", joins.place_in_time(F.col("day"), F.col("place")), F.min("place").alias("least"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    expected = {}
    for r in rows.where("key is not null").collect():
        best, least = expected.get(r.key, ((dt.date.min, -1), r.place))
        expected[r.key] = (max(best, (r.day, r.place)), min(least, r.place))
    assert sorted((r.key, ((r.day, r.place), r.least)) for r in found.collect()) == sorted(expected.items())


def test_place_in_time_orders_dates_before_places(spark):
    last = 10**27 - 1
    pairs = [(None, last), (dt.date(1, 1, 1), 5), (dt.date(1969, 12, 31), last), (dt.date(1970, 1, 1), None), (dt.date(1970, 1, 1), 1), (dt.date(9999, 12, 31), last)]
    rows = spark.createDataFrame([(n, day, at and Decimal(at)) for n, (day, at) in enumerate(pairs)], "n int, day date, at decimal(27,0)")
    placed = rows.select("n", joins.place_in_time(F.col("day"), F.col("at")).alias("place")).collect()
    assert [r.n for r in sorted(placed, key=lambda r: r.place)] == list(range(len(pairs)))
