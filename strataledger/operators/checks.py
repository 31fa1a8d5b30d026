"""Data checks. Each returns a DataFrame: the violating rows, or one row of counts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from strataledger.functions.dates import week_start
from strataledger.functions.measures import count_if
from strataledger.functions.rules import ACCOUNT_STATUSES, OPTIONAL_ACCOUNT_FIELDS, any_missing, outside
from strataledger.operators.daily import with_type
from strataledger.schemas import SOURCE_ACCOUNTS


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def distinct_against_count(rows: DataFrame, key: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("distinct_keys"))


def rejects_by_reason(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("_rejection_reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def unknown_reasons(quarantine: DataFrame, allowed: Iterable[str]) -> DataFrame:
    reason = F.col("_rejection_reason")
    return quarantine.where(reason.isNull() | ~reason.isin(*allowed))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("layer"), "row_count") for n, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)


def _tagged(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias(name))


def accounting_by_date(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Bronze rows against silver plus quarantine rows per file date; the discrepancy should be 0.

    The three grouped counts are added up by date, which keeps dates that only one side has.
    """
    names = ["bronze_rows", "silver_rows", "quarantine_rows"]
    parts = [_tagged(df, n) for df, n in zip((bronze, silver, quarantine), names)]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    gap = F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")
    return together.groupBy("date").agg(*sums).withColumn("discrepancy", gap)


def accounting_of(bronze: DataFrame, settled: DataFrame) -> DataFrame:
    """``accounting_by_date`` of rows that were settled in one pass (``_accepted`` tells their side)."""
    sides = settled.groupBy("date").agg(
        count_if(F.col("_accepted")).alias("silver_rows"), count_if(~F.col("_accepted")).alias("quarantine_rows")
    )
    together = _tagged(bronze, "bronze_rows").unionByName(sides, allowMissingColumns=True)
    names = ["bronze_rows", "silver_rows", "quarantine_rows"]
    gap = F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")
    return together.groupBy("date").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).withColumn("discrepancy", gap)


def accounting_total(by_date: DataFrame) -> DataFrame:
    names = ["bronze_rows", "silver_rows", "quarantine_rows", "discrepancy"]
    return by_date.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def null_counts(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    return rows.agg(*[count_if(F.col(c).isNull()).alias(f"null_{c.lstrip('_')}") for c in columns])


def sign_violations(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """Debits must be above zero, credits below."""
    amount, side = F.col("_signed_amount"), F.col("debit_credit_indicator")
    return silver.join(codes.select("transaction_code", "debit_credit_indicator"), "transaction_code").agg(
        count_if((side == "DR") & (amount <= 0)).alias("debit_violations"),
        count_if((side == "CR") & (amount >= 0)).alias("credit_violations"),
    )


def orphan_codes(rows: DataFrame, codes: DataFrame) -> DataFrame:
    known = codes.where(F.col("transaction_code").isNotNull()).select("transaction_code")
    return rows.join(known, "transaction_code", "left_anti")


def code_breakdown(silver: DataFrame, codes: DataFrame) -> DataFrame:
    # Counting per code first leaves the join a handful of rows.
    per_code = silver.groupBy("transaction_code").agg(F.count(F.lit(1)).alias("row_count"))
    sides = codes.select("transaction_code", "debit_credit_indicator")
    return (
        per_code.join(sides, "transaction_code")
        .groupBy("transaction_code", "debit_credit_indicator")
        .agg(F.sum("row_count").alias("row_count"))
    )


def unresolvable_rate(silver: DataFrame) -> DataFrame:
    """Share of accepted rows without a known account per file date; watched, never blocking."""
    unresolved = count_if(~F.col("_is_resolvable"))
    return (
        silver.groupBy("date")
        .agg(F.count(F.lit(1)).alias("silver_rows"), unresolved.alias("unresolvable_rows"))
        .withColumn("unresolvable_rate", F.col("unresolvable_rows").cast("double") / F.col("silver_rows"))
    )


def silver_guards(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Null signs, unresolvable rows present, and rejects that name the account as the reason."""
    sides = [silver.withColumn("_accepted", F.lit(True)), quarantine.withColumn("_accepted", F.lit(False))]
    names = ("_accepted", "_signed_amount", "_is_resolvable", "_missing_merchant_name", "_rejection_reason")
    kept, dropped = (rows.select(*[n for n in names if n in rows.columns]) for rows in sides)
    return settled_guards(kept.unionByName(dropped, allowMissingColumns=True))


def settled_guards(settled: DataFrame) -> DataFrame:
    """``silver_guards`` of rows that were settled in one pass (``_accepted`` tells their side)."""
    kept = F.col("_accepted")
    return settled.agg(
        count_if(kept & F.col("_signed_amount").isNull()).alias("null_signed_amounts"),
        count_if(kept & ~F.col("_is_resolvable")).alias("unresolvable_rows"),
        count_if(kept & F.col("_missing_merchant_name")).alias("missing_merchants"),
        count_if(F.col("_rejection_reason") == "UNRESOLVABLE_ACCOUNT_ID").alias("account_rejects"),
    )


def accounts_guards(accounts: DataFrame) -> DataFrame:
    return accounts.agg(
        F.count(F.lit(1)).alias("accounts"),
        F.countDistinct("account_id").alias("distinct_accounts"),
        count_if(any_missing(SOURCE_ACCOUNTS, OPTIONAL_ACCOUNT_FIELDS)).alias("missing_required"),
        count_if(outside("account_status", ACCOUNT_STATUSES)).alias("invalid_status"),
    )


def reconcile(published: DataFrame, recomputed: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Rows of the published table whose measures differ from a fresh aggregate (absent = zero)."""
    fresh = recomputed.select(*keys, *[F.col(m).alias(f"fresh_{m}") for m in measures])
    differs = F.lit(False)
    for m in measures:
        differs = differs | (F.coalesce(F.col(m), F.lit(0)) != F.coalesce(F.col(f"fresh_{m}"), F.lit(0)))
    pairs = [c for m in measures for c in (m, f"fresh_{m}")]
    return published.join(fresh, keys, "left").where(differs).select(*keys, *pairs)


def daily_from_silver(silver: DataFrame) -> DataFrame:
    """The four daily measures that are reconciled, straight from silver."""
    resolvable, amount = F.col("_is_resolvable"), F.col("_signed_amount")
    return silver.groupBy("transaction_date").agg(
        count_if(resolvable).alias("total_transactions"),
        F.sum(F.when(resolvable, amount)).cast("double").alias("total_signed_amount"),
        count_if(~resolvable).alias("total_unresolvable_transactions"),
        F.sum(F.when(~resolvable, amount)).cast("double").alias("total_unresolvable_amount"),
    )


DAILY_RECONCILED = [
    "total_transactions",
    "total_signed_amount",
    "total_unresolvable_transactions",
    "total_unresolvable_amount",
]


def weekly_from_silver(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """The four weekly measures that are reconciled, straight from silver, for every week."""
    amount, kind = F.col("_signed_amount"), F.col("transaction_type")
    rows = with_type(silver.where(F.col("_is_resolvable")), codes)
    return (
        rows.groupBy("account_id", week_start(F.col("transaction_date")).alias("week_start_date")).agg(
            count_if(kind == "PURCHASE").alias("total_purchases"),
            *[
                F.sum(F.when(kind == name, amount)).cast("double").alias(column)
                for name, column in (("PAYMENT", "total_payments"), ("FEE", "total_fees"), ("INTEREST", "total_interest"))
            ],
        )
    )


WEEKLY_RECONCILED = ["total_purchases", "total_payments", "total_fees", "total_interest"]


def account_weeks(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("_is_resolvable"))
        .select("account_id", week_start(F.col("transaction_date")).alias("week_start_date"))
        .distinct()
    )


def weekly_without_active_day(weekly: DataFrame, daily: DataFrame) -> DataFrame:
    """Weekly rows of a week in which no day has a transaction; an anti join on the week."""
    active = (
        daily.where(F.col("total_transactions") > 0)
        .select(week_start(F.col("transaction_date")).alias("week_start_date"))
        .distinct()
    )
    pairs = weekly.select("account_id", "week_start_date", "week_end_date").distinct()
    return pairs.join(F.broadcast(active), "week_start_date", "left_anti")  # the calendar bounds active weeks


def missing_weekly_pairs(silver: DataFrame, weekly: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """(account, week) pairs of silver without a weekly row; open weeks are left out by the registry."""
    pairs = account_weeks(silver)
    if registry is not None:
        pairs = pairs.join(F.broadcast(registry.select("week_start_date")), "week_start_date", "left_semi")
    return pairs.join(weekly.select("account_id", "week_start_date"), ["account_id", "week_start_date"], "left_anti")


def spurious_weekly_pairs(weekly: DataFrame, silver: DataFrame) -> DataFrame:
    """Weekly rows without any resolvable silver row behind them."""
    return weekly.select("account_id", "week_start_date").join(
        account_weeks(silver), ["account_id", "week_start_date"], "left_anti"
    )


def closing_balance_mismatch(weekly: DataFrame, accounts: DataFrame) -> DataFrame:
    current = accounts.select("account_id", F.col("current_balance").cast("double").alias("current_balance"))
    return (
        weekly.select("account_id", "week_start_date", "closing_balance")
        .join(current, "account_id")
        .where(F.col("closing_balance") != F.col("current_balance"))
    )


def untraceable_runs(data: Iterable[DataFrame], log: DataFrame) -> DataFrame:
    """Run ids in the data that no successful log row names."""
    ids = reduce(DataFrame.unionByName, [df.select("_pipeline_run_id").distinct() for df in data])
    done = log.where(F.col("status") == "SUCCESS").select(F.col("run_id").alias("_pipeline_run_id"))
    return ids.where(F.col("_pipeline_run_id").isNotNull()).distinct().join(done, "_pipeline_run_id", "left_anti")


def unregistered_weeks(weekly: DataFrame, registry: DataFrame) -> DataFrame:
    return weekly.select("week_start_date").distinct().join(
        registry.select("week_start_date"), "week_start_date", "left_anti"
    )


def absent_dates(expected: DataFrame, present: DataFrame, column: str = "transaction_date") -> DataFrame:
    """Expected dates (column ``date``) without a row."""
    return expected.join(present.select(F.col(column).alias("date")).distinct(), "date", "left_anti")


def content_digest(rows: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Row count and an order-free content hash, to compare a table before and after a re-run."""
    skipped = set(exclude)

    def leaves(value: Column, kind) -> list[Column]:
        """A null flag and the value of every field; the hash function skips nulls, the flags do not."""
        flag = value.isNull()
        if isinstance(kind, StructType):
            inner = sorted(kind.fields, key=lambda f: f.name)
            return [flag, *[leaf for f in inner for leaf in leaves(value.getField(f.name), f.dataType)]]
        # Minus zero and zero are the same value.
        return [flag, value + F.lit(0.0) if isinstance(kind, (DoubleType, FloatType)) else value]

    fields = [f for f in sorted(rows.schema.fields, key=lambda f: f.name) if f.name not in skipped]
    columns = [leaf for f in fields for leaf in leaves(F.col(f"`{f.name}`"), f.dataType)]
    row_hash = F.xxhash64(*columns).cast("decimal(38,0)")
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(row_hash), F.lit(0)).alias("content_hash"))
