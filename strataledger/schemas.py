"""Column contracts of every layer.

All source columns are nullable on purpose: the quality rules must see the nulls. Money is an exact
decimal inside the engine and becomes a double only in Gold, so that sums do not depend on the
order in which partial sums are merged.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(38, 2)
# Place of a row in its source file: first byte of the file's split, then the row in the split.
POSITION = DecimalType(27, 0)


def _schema(*columns: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


S, D, TS, L, B, F8 = StringType(), DateType(), TimestampType(), LongType(), BooleanType(), DoubleType()

SOURCE_TRANSACTIONS = _schema(
    ("transaction_id", S),
    ("account_id", S),
    ("transaction_date", D),
    ("amount", MONEY),
    ("transaction_code", S),
    ("merchant_name", S),
    ("channel", S),
)

SOURCE_ACCOUNTS = _schema(
    ("account_id", S),
    ("customer_name", S),
    ("account_status", S),
    ("credit_limit", MONEY),
    ("current_balance", MONEY),
    ("open_date", D),
    ("billing_cycle_start", D),
    ("billing_cycle_end", D),
)

SOURCE_CODES = _schema(
    ("transaction_code", S),
    ("description", S),
    ("debit_credit_indicator", S),
    ("transaction_type", S),
    ("affects_balance", B),
)

BRONZE_AUDIT = _schema(("_source_file", S), ("_ingested_at", TS), ("_pipeline_run_id", S))


def _plus(*parts: StructType) -> StructType:
    return StructType([field for part in parts for field in part.fields])


FILE_DATE = _schema(("date", D))

SOURCE_POSITION = _schema(("_source_position", POSITION))

BRONZE_TRANSACTIONS = _plus(SOURCE_TRANSACTIONS, BRONZE_AUDIT, SOURCE_POSITION, FILE_DATE)
BRONZE_ACCOUNTS = _plus(SOURCE_ACCOUNTS, BRONZE_AUDIT, SOURCE_POSITION, FILE_DATE)
BRONZE_CODES = _plus(SOURCE_CODES, BRONZE_AUDIT)

# Rows of a source file with another number of fields than its header, as text.
BROKEN_ROWS = _plus(_schema(("_broken_row", S)), BRONZE_AUDIT, SOURCE_POSITION, FILE_DATE)

SILVER_TRANSACTIONS = _plus(
    SOURCE_TRANSACTIONS,
    _schema(
        ("_source_file", S),
        ("_bronze_ingested_at", TS),
        ("_pipeline_run_id", S),
        ("_promoted_at", TS),
        ("_is_resolvable", B),
        ("_signed_amount", MONEY),
        ("_missing_merchant_name", B),
    ),
    FILE_DATE,
)

SILVER_ACCOUNTS = _plus(
    SOURCE_ACCOUNTS,
    _schema(
        ("_source_file", S),
        ("_bronze_ingested_at", TS),
        ("_pipeline_run_id", S),
        ("_record_valid_from", TS),
    ),
)
# The stored snapshot also keeps the file date on which an account was first accepted: the as-of
# rule for resolvable transactions needs it, and deriving it again would re-read all of bronze.
# File date and position say which of two rows of an account is the later one, also when an older
# file is promoted again.
SILVER_ACCOUNTS_STORED = _plus(
    SILVER_ACCOUNTS, _schema(("_first_seen_date", D), ("_file_date", D), ("_file_position", POSITION))
)

SILVER_CODES = _plus(
    SOURCE_CODES,
    _schema(
        ("_source_file", S),
        ("_bronze_ingested_at", TS),
        ("_pipeline_run_id", S),
        ("_promoted_at", TS),
    ),
)

QUARANTINE_TRANSACTIONS = _plus(
    SOURCE_TRANSACTIONS,
    _schema(
        ("_source_file", S),
        ("_pipeline_run_id", S),
        ("_rejected_at", TS),
        ("_rejection_reason", S),
    ),
    FILE_DATE,
)

QUARANTINE_ACCOUNTS = _plus(
    SOURCE_ACCOUNTS,
    BRONZE_AUDIT,
    _schema(("_rejected_at", TS), ("_rejection_reason", S)),
    FILE_DATE,
)

_TYPE_MEASURE = _schema(("count", L), ("sum_signed_amount", F8))

# The transaction types reported in Gold, in report order.
TRANSACTION_TYPES = ("PURCHASE", "PAYMENT", "FEE", "INTEREST")

GOLD_DAILY = _schema(
    ("transaction_date", D),
    ("total_transactions", L),
    ("total_signed_amount", F8),
    ("transactions_by_type", StructType([StructField(t, _TYPE_MEASURE, True) for t in TRANSACTION_TYPES])),
    ("online_transactions", L),
    ("instore_transactions", L),
    ("total_unresolvable_transactions", L),
    ("total_unresolvable_amount", F8),
    ("_computed_at", TS),
    ("_pipeline_run_id", S),
    ("_source_period_start", D),
    ("_source_period_end", D),
)

GOLD_WEEKLY = _schema(
    ("week_start_date", D),
    ("week_end_date", D),
    ("account_id", S),
    ("total_purchases", L),
    ("avg_purchase_amount", F8),
    ("total_payments", F8),
    ("total_fees", F8),
    ("total_interest", F8),
    ("closing_balance", F8),
    ("_computed_at", TS),
    ("_pipeline_run_id", S),
)

CONTROL = _schema(("last_processed_date", D), ("updated_at", TS), ("updated_by_run_id", S))

WEEK_REGISTRY = _schema(
    ("week_start_date", D),
    ("week_end_date", D),
    ("computed_at", TS),
    ("computed_by_run_id", S),
)

RUN_LOG = _schema(
    ("run_id", S),
    ("model_name", S),
    ("target_date", S),
    ("layer", S),
    ("started_at", S),
    ("completed_at", S),
    ("status", S),
    ("records_processed", L),
    ("records_written", L),
    ("records_rejected", L),
    ("error_message", S),
)

# One row per source file whose bronze partition is complete; written after the partition.
LOADS = _schema(
    ("entity", S), ("date", D), ("run_id", S), ("records_written", L), ("records_broken", L), ("loaded_at", TS)
)

WEEKS = _schema(("week_start_date", D), ("week_end_date", D))

# Additive daily measures per (file date, transaction date).
DAILY_MEASURES = _schema(
    ("date", D),
    ("transaction_date", D),
    ("silver_rows", L),
    ("total_transactions", L),
    ("total_signed_amount", MONEY_SUM),
    *[column for t in TRANSACTION_TYPES for column in ((f"{t.lower()}_count", L), (f"{t.lower()}_sum", MONEY_SUM))],
    ("online_transactions", L),
    ("instore_transactions", L),
    ("total_unresolvable_transactions", L),
    ("total_unresolvable_amount", MONEY_SUM),
)
