"""Gold weekly account summary: incremental, and immutable once a week is registered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataledger.functions.dates import week_start, weeks_of
from strataledger.functions.measures import weekly_measures
from strataledger.schemas import GOLD_WEEKLY


def uncomputed_weeks(resolvable_dates: DataFrame, registry: DataFrame, through: str) -> DataFrame:
    """Complete weeks (ending on or before ``through``) with resolvable rows and no registry entry.

    ``resolvable_dates`` has ``transaction_date``. Only the registry decides, never the presence of
    output files.
    """
    registered = registry.select("week_start_date")
    return (
        weeks_of(resolvable_dates, "transaction_date")
        .where(F.col("week_end_date") <= F.lit(through).cast("date"))
        .join(F.broadcast(registered), "week_start_date", "left_anti")
    )


def rows_of_weeks(silver: DataFrame, weeks: DataFrame) -> DataFrame:
    """Resolvable rows inside the given weeks, as an equi join on the Monday of each row.

    The calendar bounds the week list: DATE has about 522,000 weeks in all, so it may be broadcast.
    """
    return (
        silver.where(F.col("_is_resolvable"))
        .withColumn("week_start_date", week_start(F.col("transaction_date")))
        .join(F.broadcast(weeks.select("week_start_date")), "week_start_date")
    )


def weekly_measures_of(silver: DataFrame, codes: DataFrame, weeks: DataFrame) -> DataFrame:
    """Measures per account and week. Rows of a busy account are combined before the shuffle."""
    return (
        rows_of_weeks(silver, weeks)
        .join(codes.select("transaction_code", "transaction_type"), "transaction_code")
        .groupBy("week_start_date", "account_id")
        .agg(*weekly_measures())
        .withColumn("week_end_date", F.date_add("week_start_date", 6))
    )


def with_run_end_balance(measures: DataFrame, accounts: DataFrame) -> DataFrame:
    """Closing balance from the account snapshot of the run that computes the week."""
    balance = accounts.select("account_id", F.col("current_balance").cast("double").alias("closing_balance"))
    return measures.join(balance, "account_id")


def with_week_end_balance(measures: DataFrame, balances: DataFrame) -> DataFrame:
    """Closing balance as of the end of each week (see ``balances_at_week_end``)."""
    return measures.join(balances, ["account_id", "week_start_date"])


WEEKLY_COLUMNS = [c for c in GOLD_WEEKLY.fieldNames() if not c.startswith("_")]


def weekly_summary(silver: DataFrame, codes: DataFrame, accounts: DataFrame, weeks: DataFrame) -> DataFrame:
    return with_run_end_balance(weekly_measures_of(silver, codes, weeks), accounts).select(*WEEKLY_COLUMNS)


def gold_weekly(summary: DataFrame, run_id: str) -> DataFrame:
    return (
        summary.withColumn("_computed_at", F.current_timestamp())
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .select(*GOLD_WEEKLY.fieldNames())
    )


def merge_weeks(existing: DataFrame, new: DataFrame, weeks: DataFrame) -> DataFrame:
    """Rows of the computed weeks replace whatever was stored for them; other weeks stay as they are."""
    kept = existing.join(F.broadcast(weeks.select("week_start_date")), "week_start_date", "left_anti")
    return new.unionByName(kept, allowMissingColumns=True)
