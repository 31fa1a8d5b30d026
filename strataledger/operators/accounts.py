"""Promotion of accounts (latest row per account) and of transaction codes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataledger.functions.rules import account_reason
from strataledger.operators.joins import latest_per_key, place_in_time, replace_by_key, rows_at_greatest
from strataledger.schemas import POSITION, QUARANTINE_ACCOUNTS, SILVER_ACCOUNTS_STORED, SILVER_CODES


def classify_accounts(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("_rejection_reason", account_reason())


def passing(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("_rejection_reason").isNull()).drop("_rejection_reason")


def rejected_accounts(classified: DataFrame) -> DataFrame:
    return (
        classified.where(F.col("_rejection_reason").isNotNull())
        .withColumn("_rejected_at", F.current_timestamp())
        .select(*QUARANTINE_ACCOUNTS.fieldNames())
    )


def latest_accounts(passing_rows: DataFrame, tag: str | None = None) -> DataFrame:
    """Latest accepted row per account. In one file the later row wins, by ``tag``; without one, the row whose hash is greater."""
    return rows_at_greatest(passing_rows, "account_id", place_in_time(F.col("date"), position_of(passing_rows, tag)))


def position_of(rows: DataFrame, tag: str | None) -> Column:
    """A row's place in its file. Where it is not known, a hash of the row takes its place, so that the choice is the
    same in every run."""
    if tag:
        return F.col(tag)
    return F.xxhash64(*sorted(rows.columns)).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))


def first_seen(passing_rows: DataFrame) -> DataFrame:
    return passing_rows.groupBy("account_id").agg(F.min("date").alias("_first_seen_date"))


def incoming_accounts(passing_rows: DataFrame, tag: str | None = None) -> DataFrame:
    """The batch as snapshot rows: latest content and earliest file date."""
    place = place_in_time(F.col("date"), position_of(passing_rows, tag))
    return (
        rows_at_greatest(passing_rows, "account_id", place, F.min("date").alias("_first_seen_date"))
        .withColumn("_file_position", (F.col(tag) if tag else F.lit(None)).cast(POSITION))
        .withColumn("_file_date", F.col("date"))
        .withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumn("_record_valid_from", F.current_timestamp())
        .select(*SILVER_ACCOUNTS_STORED.fieldNames())
    )


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The later row of an account stays, by file date and place in the file; absent accounts are kept.

    So an older file that is promoted again changes nothing, and a newer one replaces the row. The
    date on which an account was first seen survives the replacement. Only stored rows of the delta's
    accounts are compared, so the snapshot is not shuffled when the delta can be broadcast.
    """
    columns = SILVER_ACCOUNTS_STORED.fieldNames()
    stored = existing.join(incoming.select("account_id"), "account_id", "left_semi").select(*columns, F.lit(0).alias("_new"))
    both = stored.unionByName(incoming.select(*columns, F.lit(1).alias("_new")))
    # Rows of the same file and place are the same source row: the newly promoted one is taken.
    place = (place_in_time(F.col("_file_date"), F.col("_file_position")) * 2 + F.col("_new")).cast("decimal(38,0)")
    later = (
        rows_at_greatest(both, "account_id", place, F.min("_first_seen_date").alias("_earliest"))
        .withColumn("_first_seen_date", F.col("_earliest"))
        .select(*columns)
    )
    return replace_by_key(existing, later, "account_id")


def promote_codes(bronze: DataFrame) -> DataFrame:
    return (
        bronze.withColumnRenamed("_ingested_at", "_bronze_ingested_at")
        .withColumn("_promoted_at", F.current_timestamp())
        .select(*SILVER_CODES.fieldNames())
    )


def balances_at_week_end(passing_rows: DataFrame, pairs: DataFrame, tag: str | None = None) -> DataFrame:
    """Balance of each (account, week) as of the end of that week: an as-of join.

    Account changes are first reduced to one row per account and day, with partial aggregates. Then
    one ordered pass per account carries the last balance forward; the calendar bounds its length.
    """
    columns = ["account_id", "date", *([tag] if tag else []), "current_balance"]
    changes = latest_per_key(passing_rows.select(*columns), ["account_id", "date"], [tag] if tag else []).select(
        "account_id", F.col("date").alias("_day"), F.lit(0).alias("_kind"), "current_balance"
    )
    asked = pairs.select(
        "account_id", "week_start_date", F.col("week_end_date").alias("_day"), F.lit(1).alias("_kind")
    )
    so_far = Window.partitionBy("account_id").orderBy("_day", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last("current_balance", ignorenulls=True).over(so_far).cast("double")
    return (
        changes.unionByName(asked, allowMissingColumns=True)
        .withColumn("closing_balance", carried)
        .where(F.col("_kind") == 1)
        .select("account_id", "week_start_date", "closing_balance")
    )
