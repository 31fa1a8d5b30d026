"""Whole runs over source files: known results, re-runs, increments, late rows, failures."""

from __future__ import annotations

import datetime as dt

import pytest
import sample
from pyspark.sql import functions as F

from strataledger.plans import control, runs, steps, verify
from strataledger.plans.runs import RunOptions
from strataledger.sources.warehouse import Warehouse


@pytest.fixture
def wh(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    return Warehouse(spark, str(tmp_path / "root"), str(source))


def daily_rows(wh):
    by_type = "transactions_by_type"
    parts = [F.col(f"{by_type}.{k}.{m}") for k in ("PURCHASE", "PAYMENT", "INTEREST") for m in ("count", "sum_signed_amount")]
    rows = wh.snapshot("gold/daily_summary").select(
        "transaction_date",
        "total_transactions",
        "total_signed_amount",
        *parts,
        "online_transactions",
        "instore_transactions",
        "total_unresolvable_transactions",
        "total_unresolvable_amount",
    )
    return {row[0]: tuple(row[1:]) for row in rows.collect()}


def weekly_rows(wh):
    rows = wh.weekly().drop("_computed_at", "_pipeline_run_id", "week_end_date").collect()
    return {
        (r.account_id, r.week_start_date): (
            r.total_purchases, r.avg_purchase_amount, r.total_payments, r.total_fees, r.total_interest, r.closing_balance,
        )
        for r in rows
    }


EXPECTED_DAILY = {sample.day(n): values for n, values in sample.DAILY.items()}
EXPECTED_WEEKLY = {(a, sample.day(1)): values for a, values in sample.WEEKLY.items()}


def counts(wh):
    return {
        "bronze": wh.dated("bronze/transactions").count(),
        "bronze_accounts": wh.dated("bronze/accounts").count(),
        "silver": wh.dated("silver/transactions").count(),
        "resolvable": wh.dated("silver/transactions").where("_is_resolvable").count(),
        "quarantine": wh.dated("quarantine/transactions").count(),
        "accounts": wh.accounts().count(),
    }


def extra(id_, date, account="ACC-001", amount="10.00", code="PURCH01", channel="ONLINE", merchant="M"):
    return f"{id_},{account},{date},{amount},{code},{merchant},{channel}"


def check_week(wh):
    assert counts(wh) == {
        "bronze": 35, "bronze_accounts": 20, "silver": 28, "resolvable": 21, "quarantine": 7, "accounts": 3,
    }
    assert daily_rows(wh) == EXPECTED_DAILY
    assert weekly_rows(wh) == EXPECTED_WEEKLY
    assert control.get_watermark(wh) == dt.date(2024, 1, 7)
    assert control.computed_weeks(wh) == {dt.date(2024, 1, 1)}


def test_life_of_a_warehouse(wh):
    """Six days, one increment, a re-run of everything, a re-run of one day, then late rows."""
    sample.write_week(wh.source, range(1, 7))
    runs.historical(wh, "2024-01-01", "2024-01-06")
    assert (wh.dated("bronze/transactions").count(), wh.dated("silver/transactions").count()) == (30, 24)
    assert len(daily_rows(wh)) == 6 and weekly_rows(wh) == {}
    assert runs.incremental(wh) is None
    assert control.get_watermark(wh) == dt.date(2024, 1, 6)
    sample.write_week(wh.source, [7])
    run_id = runs.incremental(wh)
    check_week(wh)
    log = runs.log_of(wh, run_id).collect()
    assert len(log) == 4 + 2 and {r.status for r in log} == {"SUCCESS"}
    silver = [r for r in log if r.model_name == "silver_transactions"]
    assert [(r.records_processed, r.records_written, r.records_rejected) for r in silver] == [(5, 4, 1)]

    found = {row[0]: row[1] for row in verify.suite(wh, "2024-01-01", "2024-01-07").collect()}
    assert len(found) > 30 and {name: n for name, n in found.items() if n} == {}

    before = verify.digests(wh)
    runs.historical(wh, "2024-01-01", "2024-01-07")
    assert verify.digests(wh) == before
    runs.historical(wh, "2024-01-07", "2024-01-07")
    assert verify.digests(wh) == before
    # Bronze is written once: the audit columns name the two runs that loaded it.
    assert wh.dated("bronze/transactions").select("_pipeline_run_id").distinct().count() == 2

    weekly = {tuple(r) for r in wh.weekly().collect()}
    late = [extra("LATE-1", "2024-01-03"), extra("TXN-08", "2024-01-08"), extra("TXN-01-001", "2024-01-08")]
    sample.write_day(wh.source, "2024-01-08", late, [sample.account_line(1, "9999.00")])
    runs.incremental(wh)
    assert {tuple(r) for r in wh.weekly().collect()} == weekly
    assert daily_rows(wh)[sample.day(3)][0] == 4
    assert wh.dated("silver/transactions").where("transaction_id = 'LATE-1'").first().date == dt.date(2024, 1, 8)
    reasons = wh.dated("quarantine/transactions").where("date = '2024-01-08'").collect()
    assert [(r.transaction_id, r._rejection_reason) for r in reasons] == [("TXN-01-001", "DUPLICATE_TRANSACTION_ID")]
    assert wh.accounts().where("account_id = 'ACC-001'").first().current_balance == 9999

    # A stored week that the registry does not name is replaced as a whole, ghosts included.
    wrong = wh.weekly().withColumn("total_purchases", F.lit(99).cast("long"))
    ghost = wrong.limit(1).withColumn("account_id", F.lit("GHOST"))
    staged, _ = wh.stage(wrong.unionByName(ghost), "wrong")
    wh.publish_partitions(staged, wh.WEEKLY, "week_start_date", [sample.day(1)])
    steps.publish_weekly(wh, [(sample.day(1), sample.day(7))], "again", balance_at=steps.WEEK_END)
    with_late = dict(EXPECTED_WEEKLY)
    with_late[("ACC-001", sample.day(1))] = (5, 108.0, -2000, 0, 30, 1300)
    assert weekly_rows(wh) == with_late
    assert steps.open_weeks(wh, sample.day(8)).count() == 0


def test_day_loop_equals_one_batch(spark, wh, tmp_path):
    sample.write_week(wh.source, range(1, 4))
    other = Warehouse(spark, str(tmp_path / "other"), wh.source)
    runs.historical(wh, "2024-01-01", "2024-01-03", RunOptions(days_per_batch=1))
    runs.historical(other, "2024-01-01", "2024-01-03")
    skip = verify.DIGEST_SKIP + ("_ingested_at", "_bronze_ingested_at")
    assert verify.digests(wh, skip) == verify.digests(other, skip)


def test_incremental_needs_a_watermark(wh):
    with pytest.raises(RuntimeError, match="historical"):
        runs.incremental(wh)


def test_missing_source_file_is_named(wh):
    sample.write_week(wh.source, [1, 3])
    with pytest.raises(ValueError, match="accounts_2024-01-02.csv, transactions_2024-01-02.csv"):
        runs.historical(wh, "2024-01-01", "2024-01-03")
    with pytest.raises(ValueError, match="after"):
        runs.historical(wh, "2024-01-03", "2024-01-01")


def test_late_account_does_not_repair_rows(wh):
    sample.write_codes(wh.source)
    sample.write_day(wh.source, "2024-01-01", [extra("A", "2024-01-01", account="ACC-009")], [sample.account_line(1, "1.00")])
    sample.write_day(wh.source, "2024-01-02", [extra("B", "2024-01-02", account="ACC-009")], [sample.account_line(9, "1.00")])
    runs.historical(wh, "2024-01-01", "2024-01-02")
    flags = {r.transaction_id: r._is_resolvable for r in wh.dated("silver/transactions").collect()}
    assert flags == {"A": False, "B": True}
    runs.historical(wh, "2024-01-01", "2024-01-01")
    flags = {r.transaction_id: r._is_resolvable for r in wh.dated("silver/transactions").collect()}
    assert flags == {"A": False, "B": True}


def test_rejected_days_keep_a_daily_row(wh):
    sample.write_codes(wh.source)
    account = [sample.account_line(1, "1.00")]
    for d, channel in (("2024-01-01", "FAX"), ("2024-01-02", "ONLINE"), ("2024-01-03", "FAX"), ("2024-01-04", "ONLINE"), ("2024-01-05", "FAX")):
        sample.write_day(wh.source, d, [extra(f"T{d}", d, channel=channel)], account)
    runs.historical(wh, "2024-01-01", "2024-01-05")
    assert {str(d): v[0] for d, v in daily_rows(wh).items()} == {
        "2024-01-01": 0, "2024-01-02": 1, "2024-01-03": 0, "2024-01-04": 1, "2024-01-05": 0,
    }
    steps.publish_daily(wh, "x", bounds=steps.SILVER)
    assert sorted(str(d) for d in daily_rows(wh)) == ["2024-01-02", "2024-01-03", "2024-01-04"]


def test_stale_quarantine_is_removed_on_rerun(wh):
    sample.write_codes(wh.source)
    rows = [extra("T1", "2024-01-01", code="NEW01")]
    sample.write_day(wh.source, "2024-01-01", rows, [sample.account_line(1, "1.00"), sample.account_line(2, "1.00", "GONE")])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    assert wh.dated("quarantine/transactions").count() == 1 and wh.dated("quarantine/accounts").count() == 1
    codes = wh.snapshot("bronze/transaction_codes")
    more = codes.where("transaction_code = 'PURCH01'").withColumn("transaction_code", F.lit("NEW01"))
    wh.publish_snapshot(codes.unionByName(more), "bronze/transaction_codes", "x")
    runs.historical(wh, "2024-01-01", "2024-01-01")
    assert wh.dated("quarantine/transactions").count() == 0
    assert wh.dated("silver/transactions").count() == 1


def test_failure_is_logged_and_later_steps_are_skipped(wh, monkeypatch):
    sample.write_week(wh.source, [1, 2])

    def fail(*args, **kwargs):
        raise steps.DataQualityError("broken")

    monkeypatch.setattr(steps, "promote_transactions", fail)
    with pytest.raises(steps.DataQualityError):
        runs.historical(wh, "2024-01-01", "2024-01-02", RunOptions(days_per_batch=1))
    log = {(r.model_name, r.target_date): r.status for r in wh.appended("pipeline/run_log").collect()}
    assert log[("bronze_transactions", "2024-01-01")] == "SUCCESS"
    assert log[("silver_transactions", "2024-01-01")] == "FAILED"
    assert [log[(m, "2024-01-02")] for m in ("bronze_accounts", "silver_accounts", "bronze_transactions", "silver_transactions")] == ["SKIPPED"] * 4
    assert log[("gold_daily_summary", None)] == "SKIPPED"
    assert control.get_watermark(wh) is None
    assert wh.dated("silver/transactions").count() == 0


def test_lost_run_is_recorded(wh):
    sample.write_week(wh.source, [1, 2])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    control.advance_watermark(wh, sample.day(1), "lost-run")
    assert ["lost-run" in r.error_message for r in control.lost_run_entries(wh, "now")] == [True]
    run_id = runs.incremental(wh)
    rows = runs.log_of(wh, run_id).where("model_name = 'UNLOGGED_RUN'").collect()
    assert len(rows) == 1 and "lost-run" in rows[0].error_message
    assert control.lost_run_entries(wh, "now") == []
    assert control.recent_log(wh, 3).count() == 3


def test_partial_bronze_partition_is_replaced(wh):
    sample.write_week(wh.source, [1])
    runs_batch = steps.Batch(sample.day(1), sample.day(1), "r")
    steps.load_bronze(wh, runs_batch, "transactions", steps.schemas.SOURCE_TRANSACTIONS)
    rows, _ = wh.stage(wh.dated("bronze/transactions").limit(2), "part")
    other = Warehouse(wh.spark, wh.root + "-2", wh.source)
    rows.write.partitionBy("date").parquet(other.path("bronze/transactions"))
    assert steps.load_bronze(other, runs_batch, "transactions", steps.schemas.SOURCE_TRANSACTIONS) == ({sample.day(1): 5}, {sample.day(1): 0})
    assert other.dated("bronze/transactions").count() == 5
    assert steps.load_bronze(other, runs_batch, "transactions", steps.schemas.SOURCE_TRANSACTIONS) == ({sample.day(1): 0}, {sample.day(1): 0})


def test_repeated_codes_fail(wh):
    sample.write_week(wh.source, [1])
    sample.write_file(wh.source, "transaction_codes.csv", sample.CODE_HEADER, sample.CODES + sample.CODES[:1])
    with pytest.raises(steps.DataQualityError, match="PURCH01"):
        runs.historical(wh, "2024-01-01", "2024-01-01")
