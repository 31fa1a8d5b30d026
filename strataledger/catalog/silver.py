"""Registered queries over bronze and silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataledger.catalog.registry import query
from strataledger.catalog.sql_layers import (
    ACCOUNTS,
    BRONZE,
    BRONZE_SAME_DAY,
    CLASSIFIED,
    CLASSIFIED_IN_FILE,
    CODES,
    EVENTS,
    FIRST,
    LAYERS,
    with_,
)
from strataledger.functions.rules import TRANSACTION_REASONS
from strataledger.operators import accounts as acc
from strataledger.operators import checks, joins
from strataledger.operators import transactions as txn
from strataledger.schemas import SOURCE_ACCOUNTS, SOURCE_TRANSACTIONS
from strataledger.session import scratch_path
from strataledger.sources import feeds
from strataledger.sources.ledger import IdLedger

# The ledger's batch with the ids of the first run.
FIRST_BATCH = "0-first"
TXN = SOURCE_TRANSACTIONS.fieldNames()
TXN_SQL = "transaction_id, account_id, transaction_date, CAST(amount AS DOUBLE) AS amount, transaction_code, merchant_name, channel"
ACC = SOURCE_ACCOUNTS.fieldNames()
ACC_SQL = (
    "account_id, customer_name, account_status, CAST(credit_limit AS DOUBLE) AS credit_limit, "
    "CAST(current_balance AS DOUBLE) AS current_balance, open_date, billing_cycle_start, billing_cycle_end"
)


def doubles(df, *names):
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def txn_columns(df, *extra):
    return doubles(df.select(*TXN, *extra), "amount")


def acc_columns(df, *extra):
    return doubles(df.select(*ACC, *extra), "credit_limit", "current_balance")


@query(
    "bronze_audit",
    with_(BRONZE)
    + f"""SELECT {TXN_SQL}, date, 'transactions_' || strftime(date, '%Y-%m-%d') || '.csv' AS _source_file,
          'run-' || strftime(date, '%Y-%m-%d') AS _pipeline_run_id FROM bronze""",
)
def bronze_audit(layers):
    return txn_columns(layers.bronze, "date", "_source_file", "_pipeline_run_id")


@query(
    "txn_classify",
    with_(*EVENTS) + f"SELECT {TXN_SQL}, date, reason AS _rejection_reason FROM classified",
)
def txn_classify(layers):
    return txn_columns(layers.classified, "date", "_rejection_reason")


@query(
    "txn_classify_within_file",
    with_(BRONZE_SAME_DAY, CODES, CLASSIFIED_IN_FILE)
    + f"SELECT {TXN_SQL}, date, reason AS _rejection_reason FROM classified",
)
def txn_classify_within_file(layers):
    """Repeated ids inside one file: the first occurrence that passes the other rules wins."""
    bronze = feeds.event_transactions(layers.spark, layers.sf_dir, same_day_copies=True)
    return txn_columns(txn.classify(bronze, layers.codes, dup_scope=txn.SCOPE_BATCH, stage=layers.staged), "date", "_rejection_reason")


@query(
    "txn_classify_increment",
    with_(BRONZE, CODES, CLASSIFIED)
    + f"SELECT {TXN_SQL}, date, reason AS _rejection_reason FROM classified WHERE date > {FIRST}",
)
def txn_classify_increment(layers):
    """Later files against the ids that silver already accepted on other dates, from their bucketed ledger."""
    later = layers.bronze.where(F.col("date") > F.lit(feeds.FIRST_RUN_END).cast("date"))
    buckets = int(layers.spark.conf.get("spark.sql.shuffle.partitions"))
    ledger = IdLedger(layers.spark, scratch_path(layers.spark, "accepted-ids"), buckets)
    ledger.add(layers.up_to(layers.silver, feeds.FIRST_RUN_END), FIRST_BATCH)
    history = ledger.ids({FIRST_BATCH: None})
    classified = txn.classify(later, layers.codes, history, stage=layers.staged)
    return txn_columns(classified, "date", "_rejection_reason")


SILVER_SELECT = f"""SELECT {TXN_SQL}, date, resolvable AS _is_resolvable, CAST(signed AS DOUBLE) AS _signed_amount,
  missing_merchant AS _missing_merchant_name FROM silver"""
SILVER_COLUMNS = ("date", "_is_resolvable", "_signed_amount", "_missing_merchant_name")


@query("txn_silver", with_(*LAYERS) + SILVER_SELECT)
def txn_silver(layers):
    return doubles(txn_columns(layers.silver, *SILVER_COLUMNS), "_signed_amount")


@query(
    "txn_quarantine",
    with_(*EVENTS) + f"SELECT {TXN_SQL}, date, reason AS _rejection_reason FROM classified WHERE reason IS NOT NULL",
)
def txn_quarantine(layers):
    return txn_columns(layers.quarantine, "date", "_rejection_reason")


@query(
    "txn_outcomes",
    with_(*LAYERS)
    + """SELECT transaction_id, date, CAST(signed AS DOUBLE) AS _signed_amount, resolvable AS _is_resolvable,
                CAST(NULL AS VARCHAR) AS _rejection_reason FROM silver
         UNION ALL SELECT transaction_id, date, NULL, NULL, reason FROM quarantine""",
)
def txn_outcomes(layers):
    """Both outputs in one relation, from one classification."""
    signed = F.when(F.col("_accepted"), F.col("_signed_amount")).cast("double").alias("_signed_amount")
    return layers.settled.select("transaction_id", "date", signed, "_is_resolvable", "_rejection_reason")


@query(
    "quarantine_by_reason",
    with_(*EVENTS)
    + """SELECT reason AS _rejection_reason, COUNT(*) AS rejected_rows FROM classified
         WHERE reason IS NOT NULL GROUP BY reason""",
)
def quarantine_by_reason(layers):
    return checks.rejects_by_reason(layers.quarantine)


@query(
    "unknown_reasons",
    with_(BRONZE, CODES, CLASSIFIED, ACCOUNTS)
    + """SELECT account_id, date, reason AS _rejection_reason FROM classified_accounts
         WHERE reason NOT IN ('NULL_REQUIRED_FIELD', 'INVALID_AMOUNT', 'DUPLICATE_TRANSACTION_ID',
                              'INVALID_TRANSACTION_CODE', 'INVALID_CHANNEL')""",
)
def unknown_reasons(layers):
    """Account rejects held against the list of transaction reasons."""
    rejected = acc.rejected_accounts(layers.classified_accounts)
    return checks.unknown_reasons(rejected, TRANSACTION_REASONS).select("account_id", "date", "_rejection_reason")


ACCOUNTING_SQL = with_(*EVENTS) + """, by_date AS (
  SELECT date, COUNT(*) AS bronze_rows, COUNT(*) FILTER (WHERE reason IS NULL) AS silver_rows,
         COUNT(*) FILTER (WHERE reason IS NOT NULL) AS quarantine_rows, CAST(0 AS BIGINT) AS discrepancy
  FROM classified GROUP BY date)"""


@query("accounting_by_date", ACCOUNTING_SQL + "SELECT * FROM by_date")
def accounting_by_date(layers):
    return checks.accounting_of(layers.bronze, layers.settled)


@query(
    "accounting_total",
    ACCOUNTING_SQL
    + """SELECT CAST(SUM(bronze_rows) AS BIGINT) AS bronze_rows, CAST(SUM(silver_rows) AS BIGINT) AS silver_rows,
         CAST(SUM(quarantine_rows) AS BIGINT) AS quarantine_rows, CAST(SUM(discrepancy) AS BIGINT) AS discrepancy
         FROM by_date""",
)
def accounting_total(layers):
    return checks.accounting_total(accounting_by_date(layers))


@query(
    "accounts_classify",
    with_(ACCOUNTS) + f"SELECT {ACC_SQL}, date, reason AS _rejection_reason FROM classified_accounts",
)
def accounts_classify(layers):
    return acc_columns(layers.classified_accounts, "date", "_rejection_reason")


@query(
    "accounts_quarantine",
    with_(ACCOUNTS)
    + f"SELECT {ACC_SQL}, date, reason AS _rejection_reason FROM classified_accounts WHERE reason IS NOT NULL",
)
def accounts_quarantine(layers):
    return acc_columns(acc.rejected_accounts(layers.classified_accounts), "date", "_rejection_reason")


@query("accounts_latest", with_(ACCOUNTS) + f"SELECT {ACC_SQL}, date FROM accounts")
def accounts_latest(layers):
    return acc_columns(layers.accounts, "date")


@query(
    "accounts_upsert",
    with_(ACCOUNTS)
    + f"SELECT {ACC_SQL}, first_seen_date AS _first_seen_date FROM accounts JOIN first_seen USING (account_id)",
)
def accounts_upsert(layers):
    """Two runs: the snapshot of the first one, then the later files as a delta on top of it."""
    passing = layers.passing_accounts
    existing = layers.staged(acc.incoming_accounts(layers.up_to(passing, feeds.FIRST_RUN_END)), "existing")
    later = passing.where(F.col("date") > F.lit(feeds.FIRST_RUN_END).cast("date"))
    delta = layers.staged(acc.incoming_accounts(later), "delta")
    return acc_columns(acc.upsert(existing, delta), "_first_seen_date")


@query(
    "accounts_not_superseded",
    with_(ACCOUNTS)
    + f"""SELECT {ACC_SQL} FROM first_run_accounts WHERE account_id NOT IN
          (SELECT account_id FROM passing_accounts WHERE date > {FIRST})""",
)
def accounts_not_superseded(layers):
    delta = layers.passing_accounts.where(F.col("date") > F.lit(feeds.FIRST_RUN_END).cast("date"))
    return acc_columns(joins.without_keys(layers.first_run_accounts, delta.select("account_id"), "account_id"))


@query(
    "codes_promote",
    with_(CODES)
    + """SELECT transaction_code, description, debit_credit_indicator, transaction_type, affects_balance,
         'transaction_codes.csv' AS _source_file, 'run-2024-01-01' AS _pipeline_run_id
         FROM codes WHERE transaction_code IN (SELECT event_type FROM events)""",
)
def codes_promote(layers):
    bronze = feeds.event_codes_bronze(layers.spark, layers.sf_dir)
    return acc.promote_codes(bronze).drop("_bronze_ingested_at", "_promoted_at")


@query(
    "asof_resolvable",
    with_(*LAYERS)
    + """SELECT c.transaction_id, c.account_id, c.date, first_seen_date AS _first_seen_date,
         COALESCE(first_seen_date <= c.date, false) AS _is_resolvable
         FROM classified c LEFT JOIN first_seen f ON c.account_id = f.account_id WHERE reason IS NULL""",
)
def asof_resolvable(layers):
    """The flag next to the date that decides it: accounts that arrive later never repair a row."""
    flagged = txn.resolve(layers.classified, layers.first_seen).where(F.col("_rejection_reason").isNull())
    dated = joins.left_join_eligible(
        flagged.select("transaction_id", "account_id", "date", "_is_resolvable"),
        layers.first_seen,
        "account_id",
        F.col("account_id").isNotNull(),
        ("transaction_id",),
    )
    return dated.select("transaction_id", "account_id", "date", "_first_seen_date", "_is_resolvable")
