"""Every check of the suite is silent on sound tables and fires on one broken table."""

from __future__ import annotations

import datetime as dt
import re

import pytest
import sample
from pyspark.sql import functions as F

from strataledger.plans import runs, verify
from strataledger.session import BROADCAST_CONF
from strataledger.sources.warehouse import Warehouse

from test_plans import settings

START, END = "2024-01-01", "2024-01-07"


class Altered(Warehouse):
    """A warehouse whose readers see one table changed."""

    def __init__(self, sound: Warehouse, table: str, change):
        super().__init__(sound.spark, sound.root, sound.source)
        self.table, self.change = table, change

    def _seen(self, name, rows):
        return self.change(rows).select(*rows.columns) if name == self.table else rows

    def dated(self, name):
        return self._seen(name, super().dated(name))

    def snapshot(self, name):
        return self._seen(name, super().snapshot(name))

    def appended(self, name):
        return self._seen(name, super().appended(name))

    def weekly(self):
        return self._seen(self.WEEKLY, super().weekly())


@pytest.fixture(scope="module")
def sound(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("verify")
    (folder / "source").mkdir()
    wh = Warehouse(spark, str(folder / "root"), str(folder / "source"))
    sample.write_week(wh.source)
    bad = [f"BAD,ACC-001,{sample.day(8)},5.00,PURCH01,M,FAX"]
    sample.write_day(wh.source, str(sample.day(8)), bad, [sample.account_line(1, "77.00"), sample.account_line(4, "1.00", "GONE")])
    runs.historical(wh, START, END)
    runs.incremental(wh)
    return wh


def put(column, value, kind="string"):
    return lambda rows: rows.withColumn(column, F.lit(value).cast(kind))


def plus_one(column):
    return lambda rows: rows.withColumn(column, F.col(column) + 1)


def twice(rows):
    return rows.union(rows.limit(1))


def fewer(condition):
    return lambda rows: rows.where(f"not coalesce({condition}, false)")


def added(**values):
    """One more row, like another one but for these values."""
    return lambda rows: rows.union(rows.limit(1).withColumns({c: F.lit(v).cast(rows.schema[c].dataType) for c, v in values.items()}).select(*rows.columns))


BRONZE, SILVER, QUARANTINE = "bronze/transactions", "silver/transactions", "quarantine/transactions"
ACCOUNTS, CODES, DAILY, WEEKLY = "silver/accounts", "silver/transaction_codes", "gold/daily_summary", Warehouse.WEEKLY
LOG, WEEKS = "pipeline/run_log", "pipeline/weeks"

BREAKS = {
    "source_files_missing": (BRONZE, lambda rows: rows),  # the range below reaches beyond the files
    "bronze_transactions_complete": (BRONZE, fewer("date = '2024-01-03' and transaction_id like '%1'")),
    "bronze_accounts_complete": ("bronze/accounts", fewer("date = '2024-01-03'")),
    "bronze_codes_complete": ("bronze/transaction_codes", fewer("transaction_code = 'PURCH01'")),
    "bronze_transactions_audit": (BRONZE, put("_ingested_at", None, "timestamp")),
    "bronze_accounts_audit": ("bronze/accounts", put("_source_file", None)),
    "bronze_codes_audit": ("bronze/transaction_codes", put("_pipeline_run_id", None)),
    "accounting_by_date": (SILVER, fewer("date = '2024-01-03'")),
    "accounting_total": (QUARANTINE, twice),
    "silver_duplicate_ids": (SILVER, twice),
    "silver_orphan_codes": (CODES, fewer("transaction_code = 'PURCH01'")),
    "silver_null_signed_amount": (SILVER, put("_signed_amount", None, "decimal(18,2)")),
    "silver_null_run_id": (SILVER, put("_pipeline_run_id", None)),
    "silver_debit_sign": (SILVER, put("_signed_amount", -1, "decimal(18,2)")),
    "silver_credit_sign": (SILVER, put("_signed_amount", 1, "decimal(18,2)")),
    "quarantine_reasons": (QUARANTINE, put("_rejection_reason", "OTHER")),
    "quarantine_account_reasons": ("quarantine/accounts", put("_rejection_reason", None)),
    "quarantine_null_run_id": (QUARANTINE, put("_pipeline_run_id", None)),
    "quarantine_unresolvable": (QUARANTINE, put("_rejection_reason", "UNRESOLVABLE_ACCOUNT_ID")),
    "accounts_duplicate_ids": (ACCOUNTS, twice),
    "accounts_null_run_id": (ACCOUNTS, put("_pipeline_run_id", None)),
    "accounts_audit": (ACCOUNTS, put("_record_valid_from", None, "timestamp")),
    "accounts_guards": (ACCOUNTS, put("account_status", "GONE")),
    "daily_duplicate_dates": (DAILY, twice),
    "daily_matches_silver": (DAILY, plus_one("total_transactions")),
    "daily_dates_present": (DAILY, fewer("transaction_date = '2024-01-04'")),
    "daily_null_run_id": (DAILY, put("_pipeline_run_id", None)),
    "weekly_duplicate_pairs": (WEEKLY, twice),
    "weekly_matches_silver": (WEEKLY, plus_one("total_purchases")),
    "weekly_closing_balance": (WEEKLY, plus_one("closing_balance")),
    "weekly_without_active_day": (DAILY, put("total_transactions", 0, "long")),
    "weekly_null_run_id": (WEEKLY, put("_pipeline_run_id", None)),
    "weekly_missing_pairs": (WEEKLY, fewer("account_id = 'ACC-001'")),
    "weekly_spurious_pairs": (WEEKLY, added(account_id="GHOST")),
    "weekly_unregistered": (WEEKS, fewer("true")),
    "silver_runs_traceable": (SILVER, put("_pipeline_run_id", "nobody")),
    "gold_runs_traceable": (DAILY, put("_pipeline_run_id", "nobody")),
    "log_duplicate_entries": (LOG, twice),
}


def test_sound_tables_pass(sound):
    found = {row["check"]: row["violations"] for row in verify.suite(sound, START, str(sample.day(8))).collect()}
    assert set(found) == set(BREAKS) and {name: n for name, n in found.items() if n} == {}


@pytest.mark.parametrize("name", sorted(BREAKS))
def test_check_fires(sound, name):
    table, change = BREAKS[name]
    end = "2024-01-20" if name == "source_files_missing" else END
    altered = Altered(sound, table, change)
    rows = next(rows for names, rows in verify.parts(altered, START, end) if name in names)
    assert {r["check"]: r["violations"] for r in rows.collect()}[name] > 0


def test_every_table_is_read_once(sound):
    """The checks of one table share one scan."""
    for rows, counts in verify.measured(sound):
        counted = rows.agg(*[count.alias(name) for name, count in counts.items()])
        plan = counted._jdf.queryExecution().optimizedPlan().toString()
        files = [line for line in plan.splitlines() if "Relation" in line]
        expected = 3 if "accounting_by_date" in counts else 2 if "silver_orphan_codes" in counts else 1
        assert len(files) == expected, plan


def test_an_account_that_changed_later_is_no_mismatch(sound):
    changed = sound.accounts().where("account_id = 'ACC-001'").first()
    weekly = sound.weekly().where("account_id = 'ACC-001'").first()
    assert changed.current_balance == 77 and weekly.closing_balance != 77
    assert weekly.week_end_date == dt.date(2024, 1, 7)


class Grown(Warehouse):
    """A warehouse whose accounts, weekly rows and silver rows are repeated under other ids, silver rows less often."""

    COPIES = {ACCOUNTS: 40_000, WEEKLY: 40_000, SILVER: 15_000}

    def __init__(self, sound: Warehouse, folder: str):
        super().__init__(sound.spark, sound.root, sound.source)
        tables = {SILVER: super().dated(SILVER), ACCOUNTS: super().snapshot(ACCOUNTS), WEEKLY: super().weekly()}
        for name, rows in tables.items():
            ids = {c: F.concat(c, F.md5(F.col("_copy").cast("string"))) for c in ("account_id", "transaction_id") if c in rows.columns}
            copies = rows.crossJoin(self.spark.range(self.COPIES[name]).withColumnRenamed("id", "_copy"))
            copies.withColumns(ids).drop("_copy").coalesce(4).write.parquet(f"{folder}/{name}")
        self.grown = {name: self.spark.read.schema(rows.schema).parquet(f"{folder}/{name}") for name, rows in tables.items()}

    def dated(self, name):
        return self.grown[name] if name == SILVER else super().dated(name)

    def snapshot(self, name):
        return self.grown[name] if name == ACCOUNTS else super().snapshot(name)

    def weekly(self):
        return self.grown[WEEKLY]


def test_suite_sends_no_growing_table_through_the_driver(spark, sound, tmp_path):
    """The accounts are below Spark's own limit for broadcasts; only lists that calendar, codes or runs bound are sent."""
    with settings(spark, **{BROADCAST_CONF.replace(".", "__"): "10m"}):
        suite = verify.suite(Grown(sound, str(tmp_path)), START, END)
        violations = {row["check"]: row["violations"] for row in suite.collect()}
        execution = suite._jdf.queryExecution()
        plan = execution.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    final = plan.split("== Initial Plan ==")[0]
    sent = [float(rows) for rows in re.findall(r"BroadcastQueryStage .*?rowCount=([\d.E+]+)", final)]
    assert sent and max(sent) <= 100, sorted(sent)
    unmatched = 3 * (Grown.COPIES[WEEKLY] - Grown.COPIES[SILVER])
    found = {name: n for name, n in violations.items() if n and name.startswith(("weekly", "silver", "accounts"))}
    assert found == {"weekly_matches_silver": unmatched, "weekly_spurious_pairs": unmatched}
