"""Registered queries over checks, control tables and the audit log."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataledger.catalog.registry import query
from strataledger.catalog.silver import TXN_SQL, txn_columns
from strataledger.catalog.sql_layers import (
    ACCOUNTS,
    ALL_WEEKLY,
    BRONZE,
    CODES,
    END,
    EVENTS,
    FIRST,
    FIRST_WEEKLY,
    LAYERS,
    LINEITEMS,
    REGISTERED,
    SECOND_WEEKLY,
    daily,
    with_,
)
from strataledger.functions.dates import days_between, next_day
from strataledger.operators import checks
from strataledger.operators import daily as dly
from strataledger.operators import runlog
from strataledger.sources import feeds


def cut(day: str):
    return F.lit(day).cast("date")


@query(
    "next_batch_date",
    with_(*EVENTS)
    + """SELECT MAX(date) AS last_processed_date, CAST(MAX(date) + 1 AS DATE) AS next_date FROM classified
         WHERE reason IS NULL""",
)
def next_batch_date(layers):
    mark = layers.silver.agg(F.max("date").alias("last_processed_date"))
    return mark.withColumn("next_date", next_day(F.col("last_processed_date")))


@query(
    "missing_source_dates",
    with_(BRONZE, ACCOUNTS, f"""days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01',
      CAST({END} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date)""")
    + """SELECT 'transactions' AS entity, date FROM days WHERE date NOT IN (SELECT date FROM bronze)
         UNION ALL SELECT 'accounts', date FROM days WHERE date NOT IN (SELECT date FROM bronze_accounts)""",
)
def missing_source_dates(layers):
    days = days_between(layers.spark, "2024-01-01", layers.batch_end)

    def absent(entity, rows):
        return checks.absent_dates(days, rows, "date").select(F.lit(entity).alias("entity"), "date")

    return absent("transactions", layers.bronze).unionByName(absent("accounts", layers.bronze_accounts))


LAYER_COUNTS_SQL = with_(*LAYERS, daily("daily", "silver"), ALL_WEEKLY) + " UNION ALL ".join(
    f"SELECT '{name}' AS layer, COUNT(*) AS row_count FROM {name}"
    for name in ("bronze", "silver", "quarantine", "accounts", "daily", "all_weekly")
)


@query("layer_counts", LAYER_COUNTS_SQL)
def layer_counts(layers):
    both = layers.settled_table
    layers.silver_table = both.where("_accepted")  # what follows reads the stored rows as well
    return checks.layer_counts(
        {
            "bronze": layers.bronze,
            "silver": layers.silver_table,
            "quarantine": both.where("not _accepted"),
            "accounts": layers.accounts,
            "daily": dly.daily_summary(layers.silver_table, layers.codes),
            "all_weekly": layers.all_weekly,
        }
    )


RECENT = "transaction_date, total_transactions, instore_transactions, online_transactions, total_signed_amount"


@query(
    "recent_days",
    with_(*LAYERS, daily("daily", "silver")) + f"SELECT {RECENT} FROM daily ORDER BY transaction_date DESC LIMIT 5",
)
def recent_days(layers):
    """Top-k report: the five latest days."""
    daily_rows = dly.daily_summary(layers.silver, layers.codes)
    return daily_rows.select(*RECENT.split(", ")).orderBy(F.desc("transaction_date")).limit(5)


@query(
    "resolvable_dates",
    with_(*LAYERS) + "SELECT DISTINCT transaction_date FROM silver WHERE resolvable ORDER BY transaction_date",
)
def resolvable_dates(layers):
    return layers.silver.where("_is_resolvable").select("transaction_date").distinct().orderBy("transaction_date")


@query(
    "dup_keys_1",
    with_(BRONZE) + "SELECT transaction_id, COUNT(*) AS copies FROM bronze GROUP BY 1 HAVING COUNT(*) > 1",
)
def dup_keys_1(layers):
    return checks.duplicate_keys(layers.bronze, ["transaction_id"])


@query(
    "dup_keys_2",
    with_(LINEITEMS) + "SELECT account_id, date, COUNT(*) AS copies FROM bronze GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def dup_keys_2(layers):
    return checks.duplicate_keys(feeds.lineitem_transactions(layers.spark, layers.sf_dir), ["account_id", "date"])


@query(
    "dup_keys_3",
    with_(BRONZE)
    + """SELECT account_id, transaction_code, date, COUNT(*) AS copies FROM bronze
         GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
)
def dup_keys_3(layers):
    return checks.duplicate_keys(layers.bronze, ["account_id", "transaction_code", "date"])


@query(
    "distinct_vs_count",
    with_(BRONZE) + "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT transaction_id) AS distinct_keys FROM bronze",
)
def distinct_vs_count(layers):
    return checks.distinct_against_count(layers.bronze, "transaction_id")


@query(
    "null_audit_columns",
    with_(BRONZE)
    + """SELECT CAST(0 AS BIGINT) AS null_source_file, CAST(0 AS BIGINT) AS null_ingested_at,
         CAST(0 AS BIGINT) AS null_pipeline_run_id, COUNT(*) FILTER (WHERE account_id IS NULL) AS null_account_id,
         COUNT(*) FILTER (WHERE merchant_name IS NULL) AS null_merchant_name FROM bronze""",
)
def null_audit_columns(layers):
    columns = ["_source_file", "_ingested_at", "_pipeline_run_id", "account_id", "merchant_name"]
    return checks.null_counts(layers.bronze, columns)


@query(
    "sign_violations",
    with_(*LAYERS)
    + """SELECT COUNT(*) FILTER (WHERE debit_credit_indicator = 'DR' AND signed <= 0) AS debit_violations,
         COUNT(*) FILTER (WHERE debit_credit_indicator = 'CR' AND signed >= 0) AS credit_violations FROM silver""",
)
def sign_violations(layers):
    return checks.sign_violations(layers.silver, layers.codes)


@query(
    "orphan_codes",
    with_(BRONZE, CODES)
    + f"SELECT {TXN_SQL} FROM bronze WHERE transaction_code NOT IN (SELECT transaction_code FROM codes)",
)
def orphan_codes(layers):
    return txn_columns(checks.orphan_codes(layers.bronze, layers.codes))


DAILY_FRESH = """
fresh AS (
  SELECT transaction_date, COUNT(*) FILTER (WHERE resolvable) AS total_transactions,
         CAST(SUM(signed) FILTER (WHERE resolvable) AS DOUBLE) AS total_signed_amount,
         COUNT(*) FILTER (WHERE NOT resolvable) AS total_unresolvable_transactions,
         CAST(SUM(signed) FILTER (WHERE NOT resolvable) AS DOUBLE) AS total_unresolvable_amount
  FROM silver GROUP BY transaction_date)"""


def _mismatch_sql(published: str, keys: tuple, measures: list) -> str:
    pairs = ", ".join(f"p.{m}, f.{m} AS fresh_{m}" for m in measures)
    differs = " OR ".join(f"COALESCE(p.{m}, 0) <> COALESCE(f.{m}, 0)" for m in measures)
    on = " AND ".join(f"p.{k} = f.{k}" for k in keys)
    return f"SELECT {', '.join('p.' + k for k in keys)}, {pairs} FROM {published} p LEFT JOIN fresh f ON {on} WHERE {differs}"


@query(
    "recon_daily",
    with_(*LAYERS, daily("daily", "first_run_silver"), DAILY_FRESH)
    + _mismatch_sql("daily", ("transaction_date",), checks.DAILY_RECONCILED),
)
def recon_daily(layers):
    """The daily table of the first run against silver with the rows that came later."""
    published = dly.daily_summary(layers.first_run_silver, layers.codes)
    fresh = checks.daily_from_silver(layers.silver_table)
    return checks.reconcile(published, fresh, ["transaction_date"], checks.DAILY_RECONCILED)


WEEKLY_FRESH = """
fresh AS (
  SELECT account_id, week AS week_start_date, COUNT(*) FILTER (WHERE transaction_type = 'PURCHASE') AS total_purchases,
         CAST(SUM(signed) FILTER (WHERE transaction_type = 'PAYMENT') AS DOUBLE) AS total_payments,
         CAST(SUM(signed) FILTER (WHERE transaction_type = 'FEE') AS DOUBLE) AS total_fees,
         CAST(SUM(signed) FILTER (WHERE transaction_type = 'INTEREST') AS DOUBLE) AS total_interest
  FROM silver WHERE resolvable GROUP BY account_id, week)"""


@query(
    "recon_weekly",
    with_(*LAYERS, REGISTERED, FIRST_WEEKLY, SECOND_WEEKLY, WEEKLY_FRESH)
    + f""", weekly AS (SELECT {'week_start_date, account_id, ' + ', '.join(checks.WEEKLY_RECONCILED)} FROM first_weekly
          UNION ALL SELECT {'week_start_date, account_id, ' + ', '.join(checks.WEEKLY_RECONCILED)} FROM second_weekly)
       """
    + _mismatch_sql("weekly", ("account_id", "week_start_date"), checks.WEEKLY_RECONCILED),
)
def recon_weekly(layers):
    """Registered weeks against silver: late rows show as differences, all four measures at once."""
    fresh = checks.weekly_from_silver(layers.silver_table, layers.codes)
    return checks.reconcile(layers.weekly, fresh, ["account_id", "week_start_date"], checks.WEEKLY_RECONCILED)


@query(
    "weekly_without_active_day",
    with_(*LAYERS, ALL_WEEKLY, daily("daily", "first_run_silver"))
    + """SELECT DISTINCT account_id, week_start_date, week_end_date FROM all_weekly w WHERE NOT EXISTS (
         SELECT 1 FROM daily d WHERE d.transaction_date BETWEEN w.week_start_date AND w.week_end_date
         AND d.total_transactions > 0)""",
)
def weekly_without_active_day(layers):
    """All weeks against a daily table that ends with the first run."""
    stale = dly.daily_summary(layers.first_run_silver, layers.codes)
    return checks.weekly_without_active_day(layers.all_weekly, stale)


@query(
    "missing_weekly_pairs",
    with_(*LAYERS, FIRST_WEEKLY)
    + f"""SELECT DISTINCT account_id, week AS week_start_date FROM silver WHERE resolvable AND week + 6 <= {END}
         AND (account_id, week) NOT IN (SELECT (account_id, week_start_date) FROM first_weekly)""",
)
def missing_weekly_pairs(layers):
    """All complete weeks against the weekly table of the first run; open weeks do not count."""
    return checks.missing_weekly_pairs(layers.silver_table, layers.first_weekly, layers.all_weeks).select(
        "account_id", "week_start_date"
    )


@query(
    "spurious_weekly_pairs",
    with_(*LAYERS, ALL_WEEKLY)
    + """SELECT account_id, week_start_date FROM all_weekly WHERE (account_id, week_start_date) NOT IN
         (SELECT (account_id, week) FROM first_run_silver WHERE resolvable)""",
)
def spurious_weekly_pairs(layers):
    """Weekly rows of both runs against silver of the first run only."""
    return checks.spurious_weekly_pairs(layers.all_weekly, layers.first_run_silver)


@query(
    "closing_balance_mismatch",
    with_(*LAYERS, FIRST_WEEKLY)
    + """SELECT account_id, week_start_date, closing_balance, CAST(current_balance AS DOUBLE) AS current_balance
         FROM first_weekly JOIN accounts USING (account_id) WHERE closing_balance <> CAST(current_balance AS DOUBLE)""",
)
def closing_balance_mismatch(layers):
    return checks.closing_balance_mismatch(layers.first_weekly, layers.accounts)


@query(
    "unresolvable_rate",
    with_(*LAYERS)
    + """SELECT date, COUNT(*) AS silver_rows, COUNT(*) FILTER (WHERE NOT resolvable) AS unresolvable_rows,
         CAST(COUNT(*) FILTER (WHERE NOT resolvable) AS DOUBLE) / COUNT(*) AS unresolvable_rate
         FROM silver GROUP BY date""",
)
def unresolvable_rate(layers):
    return checks.unresolvable_rate(layers.silver)


@query(
    "code_breakdown",
    with_(*LAYERS)
    + "SELECT transaction_code, debit_credit_indicator, COUNT(*) AS row_count FROM silver GROUP BY 1, 2",
)
def code_breakdown(layers):
    return checks.code_breakdown(layers.silver, layers.codes)


@query(
    "silver_guards",
    with_(*LAYERS)
    + """SELECT (SELECT COUNT(*) FROM silver WHERE signed IS NULL) AS null_signed_amounts,
         (SELECT COUNT(*) FROM silver WHERE NOT resolvable) AS unresolvable_rows,
         (SELECT COUNT(*) FROM silver WHERE missing_merchant) AS missing_merchants,
         (SELECT COUNT(*) FROM quarantine WHERE reason = 'UNRESOLVABLE_ACCOUNT_ID') AS account_rejects""",
)
def silver_guards(layers):
    return checks.settled_guards(layers.settled)


@query(
    "accounts_guards",
    with_(ACCOUNTS)
    + """SELECT COUNT(*) AS accounts, COUNT(DISTINCT account_id) AS distinct_accounts,
         COUNT(*) FILTER (WHERE current_balance IS NULL) AS missing_required,
         COUNT(*) FILTER (WHERE account_status NOT IN ('ACTIVE', 'SUSPENDED', 'CLOSED')) AS invalid_status
         FROM bronze_accounts""",
)
def accounts_guards(layers):
    """The guards over the raw account rows, where they have something to count."""
    return checks.accounts_guards(layers.bronze_accounts)


def _log_until(layers, day):
    """Log rows as the runs of the feed leave them: one failed attempt, then a success."""
    steps = (
        layers.bronze.where(F.col("date") <= cut(day))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("records_written"))
        .withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
    )
    done = F.col("attempt") == 2
    text = F.date_format("date", "yyyy-MM-dd")
    return steps.select(
        F.concat(F.lit("run-"), text).alias("run_id"),
        F.lit("bronze_transactions").alias("model_name"),
        text.alias("target_date"),
        "attempt",
        F.when(done, "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(done, F.col("records_written")).alias("records_written"),
    )


@query(
    "runlog_dedup",
    with_(BRONZE)
    + f"""SELECT 'run-' || strftime(date, '%Y-%m-%d') AS run_id, 'bronze_transactions' AS model_name,
          strftime(date, '%Y-%m-%d') AS target_date, 2 AS attempt, 'SUCCESS' AS status, COUNT(*) AS records_written
          FROM bronze WHERE date <= {END} GROUP BY date""",
)
def runlog_dedup(layers):
    return runlog.last_entries(_log_until(layers, layers.batch_end), "attempt")


@query(
    "untraceable_runs",
    with_(*LAYERS)
    + f"""SELECT DISTINCT 'run-' || strftime(date, '%Y-%m-%d') AS _pipeline_run_id FROM silver WHERE date > {FIRST}""",
)
def untraceable_runs(layers):
    """The log stops at the first run; run ids of later files have no successful entry."""
    log = _log_until(layers, feeds.FIRST_RUN_END)
    return checks.untraceable_runs([layers.silver], log)


@query(
    "unlogged_run",
    with_(BRONZE)
    + f"""SELECT 'now' AS run_id, 'UNLOGGED_RUN' AS model_name, 'ORCHESTRATION' AS layer, 'FAILED' AS status,
         'run-' || strftime(MAX(date), '%Y-%m-%d') || '{runlog.UNLOGGED_NOTE}' AS error_message FROM bronze""",
)
def unlogged_run(layers):
    mark = layers.bronze.agg(F.max("date").alias("last_processed_date"))
    run = F.concat(F.lit("run-"), F.date_format("last_processed_date", "yyyy-MM-dd"))
    control = mark.withColumn("updated_by_run_id", run).withColumn("updated_at", F.current_timestamp())
    lost = runlog.lost_runs(runlog.checked_control(control), _log_until(layers, feeds.FIRST_RUN_END))
    return runlog.lost_run_rows(lost, "now")


@query(
    "skipped_cascade",
    with_(BRONZE)
    + f""", days AS (SELECT DISTINCT date FROM bronze),
    steps AS (SELECT * FROM (VALUES (0, 'bronze_accounts', 'BRONZE'), (1, 'silver_accounts', 'SILVER'),
      (2, 'bronze_transactions', 'BRONZE'), (3, 'silver_transactions', 'SILVER')) AS t(step, model_name, layer))
    SELECT CAST(date AS VARCHAR) AS target_date, model_name, layer, 'SKIPPED' AS status FROM days, steps
    WHERE date > {FIRST} OR (date = {FIRST} AND step > 1)
    UNION ALL SELECT NULL, 'gold_daily_summary', 'GOLD', 'SKIPPED'
    UNION ALL SELECT NULL, 'gold_weekly_account_summary', 'GOLD', 'SKIPPED'""",
)
def skipped_cascade(layers):
    dates = layers.bronze.select("date").distinct()
    return runlog.skipped_steps(dates, feeds.FIRST_RUN_END, "silver_accounts")


@query(
    "unregistered_weeks",
    with_(*LAYERS, REGISTERED, ALL_WEEKLY)
    + "SELECT DISTINCT week_start_date FROM all_weekly WHERE week_start_date NOT IN (SELECT week FROM registered)",
)
def unregistered_weeks(layers):
    return checks.unregistered_weeks(layers.all_weekly, layers.first_weeks)


@query(
    "latest_week",
    with_(*LAYERS) + f"SELECT MAX(week) AS week_start_date, MAX(week) + 6 AS week_end_date FROM silver WHERE resolvable AND week + 6 <= {END}",
)
def latest_week(layers):
    return layers.all_weeks.agg(F.max("week_start_date").alias("week_start_date")).withColumn(
        "week_end_date", F.date_add("week_start_date", 6)
    )


@query(
    "expected_dates_absent",
    with_(*LAYERS)
    + f"""SELECT date FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', CAST({END} AS TIMESTAMP),
          INTERVAL 1 DAY)) AS DATE) AS date) WHERE date NOT IN (SELECT transaction_date FROM first_run_silver)""",
)
def expected_dates_absent(layers):
    days = days_between(layers.spark, "2024-01-01", layers.batch_end)
    return checks.absent_dates(days, layers.first_run_silver)


@query("content_digest")
def content_digest(layers):
    """Count and order-free hash of each layer, as a re-run comparison takes them."""
    silver = checks.content_digest(layers.silver_table, exclude=["_promoted_at"]).withColumn("layer", F.lit("silver"))
    gold = checks.content_digest(dly.daily_summary(layers.silver_table, layers.codes)).withColumn("layer", F.lit("daily"))
    return silver.unionByName(gold)
