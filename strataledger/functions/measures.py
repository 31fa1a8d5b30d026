"""Conditional aggregates used by the Gold tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataledger.schemas import MONEY_SUM, TRANSACTION_TYPES


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, amount: Column) -> Column:
    """Exact conditional sum; zero when no row qualifies."""
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast(MONEY_SUM)


def avg_if(condition: Column, amount: Column) -> Column:
    """Conditional mean as a double; null when no row qualifies."""
    total = F.sum(F.when(condition, amount)).cast("double")
    return F.when(count_if(condition) > 0, total / count_if(condition))


def signed_amount(amount: Column, indicator: Column) -> Column:
    """Debits keep the sign, credits turn it; unknown indicators give null."""
    return F.when(indicator == "DR", amount).when(indicator == "CR", -amount)


def type_columns(kind: str) -> tuple[str, str]:
    name = kind.lower()
    return f"{name}_count", f"{name}_sum"


def daily_measures() -> list[Column]:
    """One row per day: all measures are sums, so partial rows of a day can be added later."""
    resolvable = F.col("_is_resolvable")
    amount = F.col("_signed_amount")
    columns = [
        F.count(F.lit(1)).alias("silver_rows"),
        count_if(resolvable).alias("total_transactions"),
        sum_if(resolvable, amount).alias("total_signed_amount"),
    ]
    for kind in TRANSACTION_TYPES:
        of_kind = resolvable & (F.col("transaction_type") == kind)
        count_name, sum_name = type_columns(kind)
        columns += [count_if(of_kind).alias(count_name), sum_if(of_kind, amount).alias(sum_name)]
    columns += [
        count_if(resolvable & (F.col("channel") == "ONLINE")).alias("online_transactions"),
        count_if(resolvable & (F.col("channel") == "IN_STORE")).alias("instore_transactions"),
        count_if(~resolvable).alias("total_unresolvable_transactions"),
        sum_if(~resolvable, amount).alias("total_unresolvable_amount"),
    ]
    return columns


DAILY_MONEY = (
    ["total_signed_amount"] + [type_columns(kind)[1] for kind in TRANSACTION_TYPES] + ["total_unresolvable_amount"]
)
DAILY_COUNTS = (
    ["silver_rows", "total_transactions"]
    + [type_columns(kind)[0] for kind in TRANSACTION_TYPES]
    + ["online_transactions", "instore_transactions", "total_unresolvable_transactions"]
)


def added_measures() -> list[Column]:
    """Add partial rows of the same day; missing values count as zero."""
    counts = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in DAILY_COUNTS]
    money = [F.coalesce(F.sum(c), F.lit(0)).cast(MONEY_SUM).alias(c) for c in DAILY_MONEY]
    return counts + money


def weekly_measures() -> list[Column]:
    kind, amount = F.col("transaction_type"), F.col("_signed_amount")
    return [
        count_if(kind == "PURCHASE").alias("total_purchases"),
        avg_if(kind == "PURCHASE", amount).alias("avg_purchase_amount"),
        sum_if(kind == "PAYMENT", amount).cast("double").alias("total_payments"),
        sum_if(kind == "FEE", amount).cast("double").alias("total_fees"),
        sum_if(kind == "INTEREST", amount).cast("double").alias("total_interest"),
    ]
