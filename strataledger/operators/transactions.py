"""Promotion of bronze transactions: ordered classification, sign, resolvability, split."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.functions.measures import signed_amount
from strataledger.functions.rules import (
    CHANNELS,
    DUPLICATE_TRANSACTION_ID,
    INVALID_AMOUNT,
    INVALID_CHANNEL,
    INVALID_TRANSACTION_CODE,
    NULL_REQUIRED_FIELD,
    first_reason,
    outside,
    transaction_missing,
)
from strataledger.operators.joins import left_join_eligible
from strataledger.schemas import MONEY, QUARANTINE_TRANSACTIONS, SILVER_TRANSACTIONS

# Whether a repeated id inside one file is a duplicate too, or only ids accepted on other dates.
SCOPE_BATCH = "batch"
SCOPE_HISTORY = "history"

Stage = Callable[[DataFrame, str], DataFrame]

# Columns that tell rejected rows apart when they are spread over the shuffle partitions.
SPREAD_BY = ("transaction_id", "transaction_date", "amount")


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def _position(dup_scope: str, tag: str) -> Column:
    """Order of a row: its file date, or its place in the whole batch as one number. Numbers and dates can
    be aggregated by hash; a struct would sort the batch."""
    if dup_scope == SCOPE_HISTORY:
        return F.col("date")
    day = F.unix_date("date").cast("decimal(8,0)") * F.lit(str(10**27)).cast("decimal(28,0)")
    return (day + F.coalesce(F.col(tag).cast("decimal(27,0)"), F.lit(0).cast("decimal(27,0)"))).cast("decimal(38,0)")


def blocked_ids(candidates: DataFrame, history: DataFrame | None, position: Column, stage: Stage = _as_is) -> DataFrame:
    """Ids with at least one duplicate row: ``transaction_id, _first_ok, _in_history``.

    ``candidates`` carries ``_ok`` (the row passes every other rule). The earliest such row is never
    a duplicate, so it is accepted, and only accepted ids reject later rows. This equals walking the
    files day by day, without the walk. Only id and position are shuffled, combined per task first;
    ids whose rows are all fine drop out, so the result is small next to the data.

    The history may be far larger than the batch. The ids of the batch are staged first; the equality
    on a column of that table tells the optimizer to build a runtime bloom filter from it, which
    drops nearly all of the history in its scan instead of shuffling every id ever accepted.
    """
    per_id = candidates.groupBy("transaction_id").agg(
        F.min(F.when(F.col("_ok"), position)).alias("_first_ok"), F.max(position).alias("_last")
    )
    inside = per_id.where(F.col("_last") > F.col("_first_ok")).select(
        "transaction_id", "_first_ok", F.lit(False).alias("_in_history")
    )
    if history is None:
        return inside
    batch_ids = (
        stage(per_id.select("transaction_id").withColumn("_batch", F.lit(1)), "batch_ids")
        .where(F.col("_batch") == 1)
        .select("transaction_id")
    )
    known = (
        history.select("transaction_id")
        .join(batch_ids, "transaction_id", "left_semi")
        .select("transaction_id", F.lit(None).cast(inside.schema["_first_ok"].dataType).alias("_first_ok"))
        .withColumn("_in_history", F.lit(True))
    )
    return (
        inside.unionByName(known)
        .groupBy("transaction_id")
        .agg(F.min("_first_ok").alias("_first_ok"), F.max("_in_history").alias("_in_history"))
    )


def classify(
    bronze: DataFrame,
    codes: DataFrame,
    history: DataFrame | None = None,
    dup_scope: str = SCOPE_HISTORY,
    tag: str = "_row_tag",
    stage: Stage = _as_is,
) -> DataFrame:
    """Add ``_rejection_reason``, ``debit_credit_indicator`` and ``transaction_type`` to every row,
    and ``_ok``: the row passes every rule that needs no other row.

    ``bronze`` has the source columns plus the file ``date``; it may hold many dates. ``history``
    has the ids accepted on dates outside ``bronze``. With ``dup_scope="batch"`` the rows of one
    file need an order column ``tag``. ``codes`` has one row per code. ``stage`` may write the
    blocked ids to a table, so that their measured size decides how they are joined.
    """
    known_codes = codes.where(F.col("transaction_code").isNotNull()).select(
        "transaction_code", "debit_credit_indicator", "transaction_type", F.lit(True).alias("_code_known")
    )
    basic = first_reason([(NULL_REQUIRED_FIELD, transaction_missing()), (INVALID_AMOUNT, F.col("amount") <= 0)])
    bad_channel = outside("channel", CHANNELS)
    rows = (
        bronze.withColumn("_basic", basic)
        .join(known_codes, "transaction_code", "left")
        .withColumn("_ok", F.col("_basic").isNull() & F.col("_code_known").isNotNull() & ~bad_channel)
    )
    eligible = F.col("_basic").isNull()
    position = _position(dup_scope, tag)
    candidate_columns = ["transaction_id", "_ok", "date"] + ([tag] if dup_scope == SCOPE_BATCH else [])
    candidates = rows.where(eligible).select(*candidate_columns)
    blocked = stage(blocked_ids(candidates, history, position, stage), "blocked_ids")
    duplicate = F.col("_in_history") | (position > F.col("_first_ok"))
    reason = F.coalesce(
        F.col("_basic"),
        first_reason(
            [
                (DUPLICATE_TRANSACTION_ID, duplicate),
                (INVALID_TRANSACTION_CODE, F.col("_code_known").isNull()),
                (INVALID_CHANNEL, bad_channel),
            ]
        ),
    )
    return (
        left_join_eligible(rows, blocked, "transaction_id", eligible, SPREAD_BY)
        .withColumn("_rejection_reason", reason)
        .drop("_basic", "_code_known", "_first_ok", "_in_history")
    )


def resolve(classified: DataFrame, first_seen: DataFrame) -> DataFrame:
    """Add ``_is_resolvable``: the account was accepted on or before the file date.

    The flag is fixed at promotion. Accounts that arrive later never repair it. Only accepted rows
    look up their account; for rejected rows the flag is null.
    """
    accepted = F.col("_rejection_reason").isNull()
    seen = first_seen.select("account_id", F.col("_first_seen_date"))
    known = F.coalesce(F.col("_first_seen_date") <= F.col("date"), F.lit(False))
    return (
        left_join_eligible(classified, seen, "account_id", accepted, SPREAD_BY)
        .withColumn("_is_resolvable", F.when(accepted, known))
        .drop("_first_seen_date")
    )


def _promoted(resolved: DataFrame, run_id: str | Column) -> DataFrame:
    """Columns of both outputs, computed for every row."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    # An empty merchant name is present; only null is missing.
    no_merchant = (F.col("transaction_type") == "PURCHASE") & F.col("merchant_name").isNull()
    return resolved.withColumnRenamed("_ingested_at", "_bronze_ingested_at").withColumns(
        {
            "_pipeline_run_id": run,
            "_promoted_at": F.current_timestamp(),
            "_rejected_at": F.current_timestamp(),
            "_signed_amount": signed_amount(F.col("amount"), F.col("debit_credit_indicator")).cast(MONEY),
            "_missing_merchant_name": F.coalesce(no_merchant, F.lit(False)),
        }
    )


def accepted(resolved: DataFrame, run_id: str | Column) -> DataFrame:
    """Silver rows: signed, flagged, with the audit columns of this run."""
    # Without a reason a row is _ok as well. Saying so lets the optimizer drop the other rows below
    # the joins instead of shuffling them.
    kept = resolved.where(F.col("_ok") & F.col("_rejection_reason").isNull())
    return _promoted(kept, run_id).select(*SILVER_TRANSACTIONS.fieldNames())


def rejected(classified: DataFrame, run_id: str | Column) -> DataFrame:
    """Quarantine rows with their reason."""
    dropped = classified.where(F.col("_rejection_reason").isNotNull())
    return _promoted(dropped, run_id).select(*QUARANTINE_TRANSACTIONS.fieldNames())


def settled(resolved: DataFrame, run_id: str | Column) -> DataFrame:
    """Every row once, with the columns of both outputs and ``_accepted``, for a single write."""
    columns = dict.fromkeys(SILVER_TRANSACTIONS.fieldNames() + QUARANTINE_TRANSACTIONS.fieldNames())
    return _promoted(resolved, run_id).select(*columns, F.col("_rejection_reason").isNull().alias("_accepted"))


def outcomes(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Both outputs in one relation, missing columns as typed nulls."""
    return silver.unionByName(quarantine, allowMissingColumns=True)
