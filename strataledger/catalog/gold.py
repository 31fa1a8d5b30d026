"""Registered queries over the Gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataledger.catalog.registry import query
from strataledger.catalog.sql_layers import (
    ALL_WEEKLY,
    BRONZE,
    END,
    FIRST_WEEKLY,
    LAYERS,
    LINEITEMS,
    ACCOUNTS,
    CLASSIFIED,
    LINEITEM_CODES,
    ORDER_CODES,
    ORDERS,
    REGISTERED,
    SECOND_WEEKLY,
    SILVER,
    WEEKLY_COLUMNS,
    daily,
    weekly,
    with_,
)
from strataledger.functions.dates import week_end, week_start
from strataledger.operators import accounts as acc
from strataledger.operators import daily as dly
from strataledger.operators import transactions as txn
from strataledger.operators import weekly as wk
from strataledger.schemas import TRANSACTION_TYPES
from strataledger.sources import feeds


@query(
    "date_spine",
    with_(BRONZE)
    + """, bounds AS (SELECT MIN(transaction_date) AS low, MAX(transaction_date) AS high FROM bronze)
SELECT CAST(unnest(generate_series(CAST(low AS TIMESTAMP), CAST(high AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
         AS transaction_date, low AS _source_period_start, high AS _source_period_end FROM bounds""",
)
def date_spine(layers):
    bounds = layers.bronze.agg(
        F.min("transaction_date").alias("_source_period_start"), F.max("transaction_date").alias("_source_period_end")
    )
    days = F.explode(F.sequence("_source_period_start", "_source_period_end"))
    return bounds.select(days.alias("transaction_date"), "_source_period_start", "_source_period_end")


@query("gold_daily", with_(*LAYERS, daily("daily", "silver")) + "SELECT * FROM daily")
def gold_daily(layers):
    return dly.daily_summary(layers.silver, layers.codes)


@query(
    "gold_daily_struct",
    with_(*LAYERS, daily("daily", "silver"))
    + "SELECT transaction_date, "
    + ", ".join(
        f"{k.lower()}_count AS {k.lower()}_n, {k.lower()}_sum AS {k.lower()}_amount" for k in TRANSACTION_TYPES
    )
    + ", '1' AS run_id FROM daily",
)
def gold_daily_struct(layers):
    """The published nested form, read back field by field."""
    gold = dly.gold_daily(dly.dense_days(dly.daily_partials(layers.silver, layers.codes)), "1")
    fields = []
    for kind in TRANSACTION_TYPES:
        fields.append(F.col(f"transactions_by_type.{kind}.count").alias(f"{kind.lower()}_n"))
        fields.append(F.col(f"transactions_by_type.{kind}.sum_signed_amount").alias(f"{kind.lower()}_amount"))
    return gold.select("transaction_date", *fields, F.col("_pipeline_run_id").alias("run_id"))


@query(
    "gold_daily_nested",
)
def gold_daily_nested(layers):
    """The table as published, with its struct column."""
    dense = dly.dense_days(dly.daily_partials(layers.silver, layers.codes))
    return dly.gold_daily(dense, "1").drop("_computed_at")


THIN_SQL = "thin AS (SELECT * FROM silver WHERE extract(dow FROM transaction_date) = 1)"


@query(
    "gold_daily_zero_days",
    with_(*LAYERS, THIN_SQL, daily("daily", "thin")) + "SELECT * FROM daily",
)
def gold_daily_zero_days(layers):
    """Only Mondays have rows: every other day between must appear with zeros."""
    thin = layers.silver.where(F.dayofweek("transaction_date") == 2)
    return dly.daily_summary(thin, layers.codes)


@query(
    "gold_daily_processed_days",
    with_(
        *LAYERS,
        "thin AS (SELECT * FROM silver WHERE extract(dow FROM transaction_date) = 3)",
        daily("daily", "thin", "(SELECT MIN(date) FROM bronze)", "(SELECT MAX(date) FROM bronze)"),
    )
    + "SELECT * FROM daily",
)
def gold_daily_processed_days(layers):
    """Bounds from the processed files: fully rejected first and last days have a row as well."""
    thin = layers.silver.where(F.dayofweek("transaction_date") == 4)
    return dly.daily_summary(thin, layers.codes, processed=layers.bronze.select("date"))


@query("gold_daily_from_partials", with_(*LAYERS, daily("daily", "silver")) + "SELECT * FROM daily")
def gold_daily_from_partials(layers):
    """Measures per file date, added up later: the form an increment uses."""
    partials = dly.daily_partials(layers.silver, layers.codes, by=("date", "transaction_date"))
    return dly.flat_daily(dly.dense_days(dly.added_days(partials)))


@query(
    "week_of_date",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week_start_date,
       CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end_date FROM events""",
)
def week_of_date(layers):
    day = F.to_date("ts")
    return layers.table("events").select(
        "event_id",
        day.alias("day"),
        week_start(day).alias("week_start_date"),
        week_end(day).alias("week_end_date"),
    )


@query(
    "uncomputed_weeks",
    with_(*LAYERS, REGISTERED)
    + f"""SELECT DISTINCT week AS week_start_date, week + 6 AS week_end_date FROM silver
          WHERE resolvable AND week + 6 <= {END} AND week NOT IN (SELECT week FROM registered)""",
)
def uncomputed_weeks(layers):
    return layers.second_weeks


@query(
    "week_range_rows",
    with_(*LAYERS, REGISTERED)
    + """SELECT transaction_id, transaction_date, r.week AS week_start_date FROM silver s
         JOIN registered r ON s.transaction_date BETWEEN r.week AND r.week + 6 WHERE resolvable""",
)
def week_range_rows(layers):
    return wk.rows_of_weeks(layers.silver_table, layers.first_weeks).select(
        "transaction_id", "transaction_date", "week_start_date"
    )


@query("gold_weekly_first", with_(*LAYERS, FIRST_WEEKLY) + f"SELECT {WEEKLY_COLUMNS} FROM first_weekly")
def gold_weekly_first(layers):
    return layers.first_weekly


@query(
    "gold_weekly_increment",
    with_(*LAYERS, REGISTERED, SECOND_WEEKLY) + f"SELECT {WEEKLY_COLUMNS} FROM second_weekly",
)
def gold_weekly_increment(layers):
    return layers.second_weekly


@query(
    "gold_weekly_immutable",
    with_(*LAYERS, REGISTERED, FIRST_WEEKLY, SECOND_WEEKLY)
    + f"SELECT {WEEKLY_COLUMNS} FROM first_weekly UNION ALL SELECT {WEEKLY_COLUMNS} FROM second_weekly",
)
def gold_weekly_immutable(layers):
    """Late rows of a registered week are in silver but leave the weekly table as it was."""
    return layers.weekly


@query("gold_weekly_all", with_(*LAYERS, ALL_WEEKLY) + f"SELECT {WEEKLY_COLUMNS} FROM all_weekly")
def gold_weekly_all(layers):
    return layers.all_weekly


@query(
    "gold_weekly_replace",
    with_(*LAYERS, FIRST_WEEKLY, ALL_WEEKLY)
    + f"""SELECT {WEEKLY_COLUMNS} FROM all_weekly UNION ALL SELECT {WEEKLY_COLUMNS} FROM first_weekly
          WHERE week_start_date NOT IN (SELECT week_start_date FROM all_weekly)""",
)
def gold_weekly_replace(layers):
    """Stored but unregistered weeks are computed again and replaced."""
    return wk.merge_weeks(layers.first_weekly, layers.all_weekly, layers.all_weeks)


@query(
    "gold_weekly_balance_at_week_end",
    with_(*LAYERS, ALL_WEEKLY)
    + """SELECT w.account_id, w.week_start_date, w.total_purchases, CAST((SELECT arg_max(p.current_balance, p.date)
         FROM passing_accounts p WHERE p.account_id = w.account_id AND p.date <= w.week_end_date) AS DOUBLE)
         AS closing_balance FROM all_weekly w""",
)
def gold_weekly_balance_at_week_end(layers):
    measures = wk.weekly_measures_of(layers.silver_table, layers.codes, layers.all_weeks)
    balances = acc.balances_at_week_end(layers.passing_accounts, measures)
    return wk.with_week_end_balance(measures, balances).select(
        "account_id", "week_start_date", "total_purchases", "closing_balance"
    )


# Volume: the same operators over several years of orders and line items.

VOLUME_SILVER = (
    SILVER.replace("first_seen_date <= date", "first_seen_date IS NOT NULL")
)
ORDER_LAYERS = (ORDERS, ORDER_CODES, CLASSIFIED, ACCOUNTS, VOLUME_SILVER)
LINEITEM_LAYERS = (LINEITEMS, LINEITEM_CODES, CLASSIFIED, ACCOUNTS, VOLUME_SILVER)


def volume_silver(layers, bronze, codes):
    """All accounts count as known from the start: the account files are younger than the orders."""
    known = layers.first_seen.withColumn("_first_seen_date", F.lit("1900-01-01").cast("date"))
    return txn.accepted(txn.resolve(txn.classify(bronze, codes, stage=layers.staged), known), "volume")


def lineitem_bronze(layers):
    """Stored, so the join with the orders runs once and not once per use."""
    rows = layers.staged(feeds.lineitem_rows(layers.spark, layers.sf_dir), "lineitem")
    return feeds.audited(rows, "lineitem")


def last_day(rows) -> str:
    """The last transaction date present; weeks that end by then are complete."""
    return str(rows.agg(F.max("transaction_date")).first()[0])


def order_silver(layers):
    return volume_silver(
        layers, feeds.order_transactions(layers.spark, layers.sf_dir), feeds.order_codes(layers.spark)
    )


def lineitem_silver(layers):
    return volume_silver(layers, lineitem_bronze(layers), feeds.lineitem_codes(layers.spark))


@query("daily_orders", with_(*ORDER_LAYERS, daily("daily", "silver")) + "SELECT * FROM daily")
def daily_orders(layers):
    return dly.daily_summary(order_silver(layers), feeds.order_codes(layers.spark))


@query(
    "weekly_customer_orders",
    with_(*ORDER_LAYERS, weekly("weekly", "silver", "accounts", "week + 6 <= (SELECT MAX(transaction_date) FROM bronze)"))
    + f"SELECT {WEEKLY_COLUMNS} FROM weekly",
)
def weekly_customer_orders(layers):
    silver = order_silver(layers)
    dates = feeds.order_transactions(layers.spark, layers.sf_dir)
    weeks = layers.listed(wk.uncomputed_weeks(dates, layers.no_weeks, last_day(dates)))
    return wk.weekly_summary(silver, feeds.order_codes(layers.spark), layers.accounts, weeks)


@query(
    "lineitem_classify",
    with_(LINEITEMS, LINEITEM_CODES, CLASSIFIED)
    + """SELECT transaction_id, account_id, transaction_date, CAST(amount AS DOUBLE) AS amount, transaction_code,
         date, reason AS _rejection_reason FROM classified""",
)
def lineitem_classify(layers):
    """Many ids repeat here, across dates and inside one date."""
    classified = txn.classify(lineitem_bronze(layers), feeds.lineitem_codes(layers.spark), stage=layers.staged)
    return classified.select(
        "transaction_id",
        "account_id",
        "transaction_date",
        F.col("amount").cast("double").alias("amount"),
        "transaction_code",
        "date",
        "_rejection_reason",
    )


@query("daily_lineitems", with_(*LINEITEM_LAYERS, daily("daily", "silver")) + "SELECT * FROM daily")
def daily_lineitems(layers):
    return dly.daily_summary(lineitem_silver(layers), feeds.lineitem_codes(layers.spark))


@query(
    "weekly_customer_lineitems",
    with_(*LINEITEM_LAYERS, weekly("weekly", "silver", "accounts", "week + 6 <= (SELECT MAX(transaction_date) FROM bronze)"))
    + f"SELECT {WEEKLY_COLUMNS} FROM weekly",
)
def weekly_customer_lineitems(layers):
    silver = lineitem_silver(layers)
    bronze_dates = layers.table("lineitem").select(F.to_date("l_shipdate").alias("transaction_date"))
    weeks = layers.listed(wk.uncomputed_weeks(bronze_dates, layers.no_weeks, last_day(bronze_dates)))
    return wk.weekly_summary(silver, feeds.lineitem_codes(layers.spark), layers.accounts, weeks)
