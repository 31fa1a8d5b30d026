"""Single rules, their order, and promotion details on small fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataledger import schemas
from strataledger.functions.dates import days_between, week_end, week_start
from strataledger.operators import accounts as acc
from strataledger.operators import checks, runlog
from strataledger.operators import daily as dly
from strataledger.operators import transactions as txn
from strataledger.operators import weekly as wk
from strataledger.sources.files import local_frame

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
CODES = [("P", "", "DR", "PURCHASE", True), ("C", "", "CR", "PAYMENT", True), ("Z", "", None, "OTHER", True)]


def row(id_="T", account="A", date=D1, amount="5.00", code="P", merchant="M", channel="ONLINE", file=D1, tag=0):
    money = None if amount is None else Decimal(amount)
    return (id_, account, date, money, code, merchant, channel, "f.csv", None, "bronze-run", file, tag)


def tagged(schema):
    """A bronze schema as a batch sees it: the position is the row tag."""
    fields = [f for f in schema.fields if f.name != "_source_position"]
    return schemas.StructType(fields + [schemas.StructField("_row_tag", schemas.L)])


TAGGED = tagged(schemas.BRONZE_TRANSACTIONS)


def bronze(spark, rows):
    return local_frame(spark, rows, TAGGED)


def codes(spark, extra=()):
    return local_frame(spark, CODES + list(extra), schemas.SOURCE_CODES)


def reasons(classified):
    return sorted((r.transaction_id, str(r.date), r._row_tag, r._rejection_reason) for r in classified.collect())


CASES = [
    (dict(), None),
    (dict(id_=None), "NULL_REQUIRED_FIELD"),
    (dict(id_=""), "NULL_REQUIRED_FIELD"),
    (dict(account=None), "NULL_REQUIRED_FIELD"),
    (dict(account=""), "NULL_REQUIRED_FIELD"),
    (dict(date=None), "NULL_REQUIRED_FIELD"),
    (dict(amount=None), "NULL_REQUIRED_FIELD"),
    (dict(code=None), "NULL_REQUIRED_FIELD"),
    (dict(code=""), "NULL_REQUIRED_FIELD"),
    (dict(channel=None), "NULL_REQUIRED_FIELD"),
    (dict(channel=""), "NULL_REQUIRED_FIELD"),
    (dict(merchant=None), None),
    (dict(amount="0.00"), "INVALID_AMOUNT"),
    (dict(amount="-1.00"), "INVALID_AMOUNT"),
    (dict(code="??"), "INVALID_TRANSACTION_CODE"),
    (dict(channel="FAX"), "INVALID_CHANNEL"),
    (dict(code="??", channel="FAX"), "INVALID_TRANSACTION_CODE"),
    (dict(amount="0.00", code="??"), "INVALID_AMOUNT"),
    (dict(account=None, amount="0.00"), "NULL_REQUIRED_FIELD"),
]


def test_each_reason_and_their_order(spark):
    rows = []
    for i, (change, _) in enumerate(CASES):
        rows.append(row(**{"id_": f"T{i}", "tag": i, **change}))
    got = {r._row_tag: r._rejection_reason for r in txn.classify(bronze(spark, rows), codes(spark)).collect()}
    assert [got[i] for i in range(len(CASES))] == [expected for _, expected in CASES]


def test_duplicates_across_dates(spark):
    rows = [
        row("A", file=D1), row("A", file=D2), row("A", file=D3, code="??"),  # accepted, duplicate, duplicate
        row("B", file=D1, channel="FAX"), row("B", file=D2), row("B", file=D3, channel="FAX"),
        row("C", file=D1, amount="0.00"), row("C", file=D2, amount="0.00"),
        row("E", file=D1, code="??"), row("E", file=D2, code="??"),
    ]
    expected = [
        ("A", str(D1), 0, None), ("A", str(D2), 0, "DUPLICATE_TRANSACTION_ID"), ("A", str(D3), 0, "DUPLICATE_TRANSACTION_ID"),
        ("B", str(D1), 0, "INVALID_CHANNEL"), ("B", str(D2), 0, None), ("B", str(D3), 0, "DUPLICATE_TRANSACTION_ID"),
        ("C", str(D1), 0, "INVALID_AMOUNT"), ("C", str(D2), 0, "INVALID_AMOUNT"),
        ("E", str(D1), 0, "INVALID_TRANSACTION_CODE"), ("E", str(D2), 0, "INVALID_TRANSACTION_CODE"),
    ]
    assert reasons(txn.classify(bronze(spark, rows), codes(spark))) == expected


def test_duplicates_within_a_file(spark):
    rows = [row("A", tag=1), row("A", tag=2), row("A", tag=0, channel="FAX")]
    both = reasons(txn.classify(bronze(spark, rows), codes(spark)))
    assert [r[3] for r in both] == ["INVALID_CHANNEL", None, None]
    first = reasons(txn.classify(bronze(spark, rows), codes(spark), dup_scope=txn.SCOPE_BATCH))
    assert [r[3] for r in first] == ["INVALID_CHANNEL", None, "DUPLICATE_TRANSACTION_ID"]


@pytest.mark.parametrize("scope", [txn.SCOPE_HISTORY, txn.SCOPE_BATCH])
def test_duplicates_of_history(spark, scope):
    rows = [row("OLD", tag=0), row("NEW", tag=1), row("OLD", tag=2, amount="0.00"), row(None, tag=3)]
    history = local_frame(spark, [("OLD",), ("OLD",), (None,), ("GONE",)], schemas._schema(("transaction_id", schemas.S)))
    got = {r._row_tag: r._rejection_reason for r in txn.classify(bronze(spark, rows), codes(spark), history, scope).collect()}
    assert got == {0: "DUPLICATE_TRANSACTION_ID", 1: None, 2: "INVALID_AMOUNT", 3: "NULL_REQUIRED_FIELD"}


def test_null_code_in_the_list_changes_nothing(spark):
    rows = [row("A"), row("B", code="??")]
    with_null = codes(spark, [(None, "", "DR", "PURCHASE", True)])
    got = {r.transaction_id: r._rejection_reason for r in txn.classify(bronze(spark, rows), with_null).collect()}
    assert got == {"A": None, "B": "INVALID_TRANSACTION_CODE"}


def promoted(spark, rows, seen):
    first_seen = local_frame(spark, seen, schemas._schema(("account_id", schemas.S), ("_first_seen_date", schemas.D)))
    resolved = txn.resolve(txn.classify(bronze(spark, rows), codes(spark)), first_seen)
    return resolved


def test_sign_flags_and_split(spark):
    rows = [
        row("A", code="P", merchant=None), row("B", code="C", merchant=None), row("Z", code="Z"),
        row("E", merchant=""), row("L", account="LATE"), row("N", account="NOBODY"), row("R", channel="FAX"),
    ]
    resolved = promoted(spark, rows, [("A", D1), ("LATE", D2)])
    silver = {r.transaction_id: r for r in txn.accepted(resolved, "run").collect()}
    assert {k: r._signed_amount for k, r in silver.items()} == {
        "A": Decimal("5.00"), "B": Decimal("-5.00"), "Z": None, "E": Decimal("5.00"), "L": Decimal("5.00"), "N": Decimal("5.00"),
    }
    assert [k for k, r in silver.items() if r._missing_merchant_name] == ["A"]
    assert sorted(k for k, r in silver.items() if not r._is_resolvable) == ["L", "N"]
    rejects = txn.rejected(resolved, "run").collect()
    assert [(r.transaction_id, r._rejection_reason, r._pipeline_run_id) for r in rejects] == [("R", "INVALID_CHANNEL", "run")]
    settled = txn.settled(resolved, "run")
    assert settled.count() == len(rows) and settled.where("_accepted").count() == len(silver)
    assert checks.silver_guards(txn.accepted(resolved, "run"), txn.rejected(resolved, "run")).first().null_signed_amounts == 1


def account(id_, balance="1.00", status="ACTIVE", date=D1, tag=0, name="N", limit="9.00"):
    money = [None if v is None else Decimal(v) for v in (limit, balance)]
    return (id_, name, status, *money, D1, D1, D3, "f.csv", None, "r", date, tag)


TAGGED_ACCOUNTS = tagged(schemas.BRONZE_ACCOUNTS)


def test_account_reasons_and_upsert(spark):
    rows = [
        account("A", "1.00"), account("A", "2.00", date=D2, tag=1), account("A", "3.00", date=D2, tag=2),
        account("B", status="GONE"), account("C", None), account("", status="GONE"), account("D", name=None), account("E", status=""),
    ]
    classified = acc.classify_accounts(local_frame(spark, rows, TAGGED_ACCOUNTS))
    got = [(r.account_id, r._rejection_reason) for r in classified.orderBy("date", "account_id").collect() if r._rejection_reason]
    assert sorted(got) == [
        ("", "NULL_REQUIRED_FIELD"), ("B", "INVALID_ACCOUNT_STATUS"), ("C", "NULL_REQUIRED_FIELD"), ("E", "NULL_REQUIRED_FIELD"),
    ]
    incoming = acc.incoming_accounts(acc.passing(classified), "_row_tag")
    content = {r.account_id: (r.current_balance, r._first_seen_date) for r in incoming.collect()}
    assert content == {"A": (Decimal("3.00"), D1), "D": (Decimal("1.00"), D1)}
    later = acc.classify_accounts(local_frame(spark, [account("D", "7.00", date=D3), account("F", date=D3)], TAGGED_ACCOUNTS))
    merged = acc.upsert(incoming, acc.incoming_accounts(acc.passing(later), "_row_tag"))
    content = {r.account_id: (r.current_balance, r._first_seen_date) for r in merged.collect()}
    assert content == {"A": (Decimal("3.00"), D1), "D": (Decimal("7.00"), D1), "F": (Decimal("1.00"), D3)}


def test_week_without_purchases_has_no_average(spark):
    silver = txn.accepted(promoted(spark, [row("A", code="C", date=D2)], [("A", D1)]), "r")
    weeks = wk.uncomputed_weeks(silver, local_frame(spark, [], schemas.WEEK_REGISTRY), "2024-01-07")
    accounts = local_frame(spark, [account("A", "4.00")[:11] + (None,)], schemas.SILVER_ACCOUNTS)
    got = wk.weekly_summary(silver, codes(spark), accounts, weeks).first()
    assert (got.total_purchases, got.avg_purchase_amount, got.total_payments, got.closing_balance) == (0, None, -5.0, 4.0)
    assert (str(got.week_start_date), str(got.week_end_date)) == ("2024-01-01", "2024-01-07")
    assert wk.uncomputed_weeks(silver, local_frame(spark, [], schemas.WEEK_REGISTRY), "2024-01-06").count() == 0
    done = local_frame(spark, [(D1, dt.date(2024, 1, 7), None, "r")], schemas.WEEK_REGISTRY)
    assert wk.uncomputed_weeks(silver, done, "2024-01-31").count() == 0


def test_empty_inputs(spark):
    silver = local_frame(spark, [], schemas.SILVER_TRANSACTIONS)
    assert dly.daily_summary(silver, codes(spark)).count() == 0
    weeks = local_frame(spark, [], schemas.WEEKS)
    accounts = local_frame(spark, [], schemas.SILVER_ACCOUNTS)
    assert wk.weekly_summary(silver, codes(spark), accounts, weeks).count() == 0
    assert dly.gold_daily(dly.dense_days(dly.daily_partials(silver, codes(spark))), "r").schema.fieldNames() == schemas.GOLD_DAILY.fieldNames()


def test_weeks_over_calendar_ends(spark):
    days = days_between(spark, "2023-12-30", "2024-03-02").select(
        "date", week_start(F.col("date")).alias("a"), week_end(F.col("date")).alias("b")
    )
    for r in days.collect():
        monday = r.date - dt.timedelta(days=r.date.weekday())
        assert (r.a, r.b) == (monday, monday + dt.timedelta(days=6))


def test_control_row_is_checked(spark):
    none = local_frame(spark, [], schemas.CONTROL)
    one = local_frame(spark, [(D1, None, "r1")], schemas.CONTROL)
    log = local_frame(spark, [("r0", "m", None, None, None, None, "SUCCESS", None, None, None, None)], schemas.RUN_LOG)
    assert runlog.checked_control(none).count() == 0
    assert [r.run_id for r in runlog.lost_runs(runlog.checked_control(one), log).collect()] == ["r1"]
    for bad in ([(D1, None, "r1"), (D2, None, "r2")], [(D1, None, None)]):
        with pytest.raises(Exception, match="control table"):
            runlog.checked_control(local_frame(spark, bad, schemas.CONTROL)).collect()


def test_digest_ignores_order_and_sees_changes(spark):
    a = local_frame(spark, [(D1, D2), (D2, D3)], schemas.WEEKS)
    b = local_frame(spark, [(D2, D3), (D1, D2)], schemas.WEEKS)
    c = local_frame(spark, [(D2, D3), (D1, D3)], schemas.WEEKS)
    assert checks.content_digest(a).first() == checks.content_digest(b).first() != checks.content_digest(c).first()
