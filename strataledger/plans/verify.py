"""The verification suite over a warehouse: one row per check with its number of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.functions.dates import week_start
from strataledger.functions.measures import count_if
from strataledger.functions.rules import ACCOUNT_REASONS, TRANSACTION_REASONS, account_reason
from strataledger.operators import checks
from strataledger.sources.files import bronze_rows, missing_sources, source_dates
from strataledger.sources.warehouse import Warehouse, within
from strataledger.schemas import SOURCE_ACCOUNTS, SOURCE_CODES, SOURCE_TRANSACTIONS

AUDIT = ("_source_file", "_ingested_at", "_pipeline_run_id")


def _null(*columns: str) -> Column:
    """Rows in which one of the columns is null."""
    return count_if(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def _surplus(*keys: str) -> Column:
    """Rows beyond the first one of each key; null keys count as keys."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))


def measured(wh: Warehouse) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Checks that need one table, or one and the short code list: all checks of a table are one aggregate, so
    the table is read once."""
    codes = wh.snapshot("silver/transaction_codes")
    known = codes.where("transaction_code is not null").select(
        "transaction_code", "debit_credit_indicator", F.lit(True).alias("_known")
    )
    side, amount = F.col("debit_credit_indicator"), F.col("_signed_amount")
    reason = F.col("_rejection_reason")

    def unknown(allowed) -> Column:
        return count_if(reason.isNull() | ~reason.isin(*allowed))

    by_date = checks.accounting_by_date(
        wh.dated("bronze/transactions"), wh.dated("silver/transactions"), wh.dated("quarantine/transactions")
    )
    return [
        (wh.dated("bronze/transactions"), {"bronze_transactions_audit": _null(*AUDIT)}),
        (wh.dated("bronze/accounts"), {"bronze_accounts_audit": _null(*AUDIT)}),
        (wh.snapshot("bronze/transaction_codes"), {"bronze_codes_audit": _null(*AUDIT)}),
        (
            by_date,
            {
                "accounting_by_date": count_if(F.col("discrepancy") != 0),
                "accounting_total": F.abs(F.coalesce(F.sum("discrepancy"), F.lit(0))),
            },
        ),
        (
            wh.dated("silver/transactions").join(known, "transaction_code", "left"),
            {
                "silver_duplicate_ids": _surplus("transaction_id"),
                "silver_orphan_codes": _null("_known"),
                "silver_null_signed_amount": _null("_signed_amount"),
                "silver_null_run_id": _null("_pipeline_run_id"),
                "silver_debit_sign": count_if((side == "DR") & (amount <= 0)),
                "silver_credit_sign": count_if((side == "CR") & (amount >= 0)),
            },
        ),
        (
            wh.dated("quarantine/transactions"),
            {
                "quarantine_reasons": unknown(TRANSACTION_REASONS),
                "quarantine_null_run_id": _null("_pipeline_run_id"),
                "quarantine_unresolvable": count_if(reason == "UNRESOLVABLE_ACCOUNT_ID"),
            },
        ),
        (wh.dated("quarantine/accounts"), {"quarantine_account_reasons": unknown(ACCOUNT_REASONS)}),
        (
            wh.accounts(),
            {
                "accounts_duplicate_ids": _surplus("account_id"),
                "accounts_null_run_id": _null("_pipeline_run_id"),
                "accounts_audit": _null("_source_file", "_bronze_ingested_at", "_pipeline_run_id", "_record_valid_from"),
                "accounts_guards": count_if(account_reason().isNotNull()),
            },
        ),
        (
            wh.snapshot("gold/daily_summary"),
            {"daily_duplicate_dates": _surplus("transaction_date"), "daily_null_run_id": _null("_pipeline_run_id")},
        ),
        (
            wh.weekly(),
            {"weekly_duplicate_pairs": _surplus("account_id", "week_start_date"), "weekly_null_run_id": _null("_pipeline_run_id")},
        ),
        (wh.appended("pipeline/run_log"), {"log_duplicate_entries": _surplus("run_id", "model_name", "target_date")}),
    ]


def violations(wh: Warehouse, start: str, end: str) -> dict[str, DataFrame]:
    """Violating rows by check name, for checks that compare tables; every frame should be empty."""
    bronze, accounts_bronze = wh.dated("bronze/transactions"), wh.dated("bronze/accounts")
    silver, codes = wh.dated("silver/transactions"), wh.snapshot("silver/transaction_codes")
    daily, weekly = wh.snapshot("gold/daily_summary"), wh.weekly()
    log, registry = wh.appended("pipeline/run_log"), wh.appended("pipeline/weeks")

    def incomplete(entity: str, schema, table: DataFrame) -> DataFrame:
        """Dates of the range whose file and partition differ in rows, or that only one side has."""
        listed = within(source_dates(wh.spark, wh.source, entity), start, end)
        days = sorted(row[0] for row in listed.collect())  # the calendar bounds them
        both = table.select("date").unionByName(wh.dated(f"bronze/broken_{entity}").select("date"))
        loaded = within(both, start, end).groupBy("date").agg(F.count(F.lit(1)).alias("loaded"))
        if not days:
            return loaded.withColumn("expected", F.lit(0).cast("long"))
        paths = [f"{wh.source}/{entity}_{day}.csv" for day in days]
        rows = bronze_rows(wh.spark, paths, schema, "check", wh.multiline)
        source = rows.groupBy("date").agg(F.count(F.lit(1)).alias("expected"))
        pairs = loaded.join(source, "date", "full")
        return pairs.where(F.coalesce("loaded", F.lit(0)) != F.coalesce("expected", F.lit(0)))

    def uneven(one: DataFrame, other: DataFrame) -> DataFrame:
        return one.exceptAll(other).unionAll(other.exceptAll(one))

    def seen_by_week(rows: DataFrame) -> DataFrame:
        """Silver rows of file dates that were promoted before their week was computed. Later rows never enter it."""
        done = log.where("model_name = 'silver_transactions' and status = 'SUCCESS'")
        promoted = done.groupBy(F.col("target_date").cast("date").alias("date")).agg(
            F.min(F.col("completed_at").cast("timestamp")).alias("promoted_at")
        )
        computed = registry.select("week_start_date", "computed_at")
        placed = rows.withColumn("week_start_date", week_start(F.col("transaction_date")))
        # The calendar bounds both lists. Without a log row for its date, a row counts as seen.
        timed = placed.join(F.broadcast(promoted), "date", "left").join(F.broadcast(computed), "week_start_date", "left")
        late = F.col("promoted_at") > F.col("computed_at")
        return timed.where(~F.coalesce(late, F.lit(False))).select(*rows.columns)

    def unchanged_since(rows: DataFrame) -> DataFrame:
        """Accounts whose latest row came from a file of the week or earlier, and before the week was computed."""
        stored = wh.snapshot("silver/accounts").select("account_id", "_file_date", "_record_valid_from")
        same = (F.col("_file_date") <= F.col("week_end_date")) & (F.col("_record_valid_from") <= F.col("_computed_at"))
        return rows.join(stored, "account_id").where(same).select(*rows.columns)

    in_range = F.col("transaction_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    seen = seen_by_week(silver)
    days = wh.spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date")
    )
    return {
        "source_files_missing": missing_sources(wh.spark, wh.source, start, end),
        "bronze_transactions_complete": incomplete("transactions", SOURCE_TRANSACTIONS, bronze),
        "bronze_accounts_complete": incomplete("accounts", SOURCE_ACCOUNTS, accounts_bronze),
        "bronze_codes_complete": uneven(
            wh.snapshot("bronze/transaction_codes").select("transaction_code"),
            bronze_rows(wh.spark, [f"{wh.source}/transaction_codes.csv"], SOURCE_CODES, "check", wh.multiline).select(
                "transaction_code"
            ),
        ),
        "daily_matches_silver": checks.reconcile(
            daily, checks.daily_from_silver(silver), ["transaction_date"], checks.DAILY_RECONCILED
        ),
        "daily_dates_present": checks.absent_dates(days, daily.where(in_range)),
        "weekly_matches_silver": checks.reconcile(
            weekly, checks.weekly_from_silver(seen, codes), ["account_id", "week_start_date"], checks.WEEKLY_RECONCILED
        ),
        "weekly_closing_balance": checks.closing_balance_mismatch(unchanged_since(weekly), wh.accounts()),
        "weekly_without_active_day": checks.weekly_without_active_day(weekly, daily),
        "weekly_missing_pairs": checks.missing_weekly_pairs(seen, weekly, registry.where("week_start_date is not null")),
        "weekly_spurious_pairs": checks.spurious_weekly_pairs(weekly, silver),
        "weekly_unregistered": checks.unregistered_weeks(weekly, registry),
        "silver_runs_traceable": checks.untraceable_runs([silver, wh.accounts()], log),
        "gold_runs_traceable": checks.untraceable_runs([daily, weekly], log),
    }


def parts(wh: Warehouse, start: str, end: str) -> list[tuple[list[str], DataFrame]]:
    """Names of checks and the ``check, violations`` rows of these checks."""

    def listed(counted: DataFrame, names: list[str]) -> DataFrame:
        pairs = [F.struct(F.lit(name).alias("check"), F.col(name).cast("long").alias("violations")) for name in names]
        return counted.select(F.inline(F.array(*pairs)))

    found = []
    for rows, counts in measured(wh):
        found.append((list(counts), listed(rows.agg(*[count.alias(name) for name, count in counts.items()]), list(counts))))
    for name, rows in violations(wh, start, end).items():
        found.append(([name], listed(rows.agg(F.count(F.lit(1)).alias(name)), [name])))
    return found


def suite(wh: Warehouse, start: str, end: str) -> DataFrame:
    """``check, violations`` for every check."""
    return reduce(DataFrame.unionByName, [rows for _, rows in parts(wh, start, end)])


DIGEST_SKIP = ("_promoted_at", "_rejected_at", "_computed_at", "_record_valid_from", "_pipeline_run_id")


def digests(wh: Warehouse, skip: tuple = DIGEST_SKIP) -> dict[str, tuple]:
    """Row count and content hash per table, to compare before and after a re-run. Run ids and times
    of writing are left out."""
    tables = {
        "bronze/transactions": wh.dated("bronze/transactions"),
        "bronze/accounts": wh.dated("bronze/accounts"),
        "silver/transactions": wh.dated("silver/transactions"),
        "silver/accounts": wh.accounts(),
        "quarantine/transactions": wh.dated("quarantine/transactions"),
        "quarantine/accounts": wh.dated("quarantine/accounts"),
        "gold/daily_summary": wh.snapshot("gold/daily_summary"),
        "gold/weekly_account_summary": wh.weekly(),
    }
    return {name: tuple(checks.content_digest(rows, skip).first()) for name, rows in tables.items()}
