"""Registered queries over whole runs: dated CSV files in, published tables out.

The event and customer feeds are written as source files, then three runs promote them: a historical range
up to the first run's end, one increment, and a historical range for the rest. Events that are sent again
arrive in later files, so late rows, late copies and late repairs all occur. The queries read what was published.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataledger import schemas
from strataledger.catalog.control import cut
from strataledger.catalog.registry import query
from strataledger.catalog.silver import ACC_SQL, TXN_SQL, acc_columns, doubles, txn_columns
from strataledger.catalog.sql_layers import (
    ACCOUNTS,
    BRONZE,
    END,
    EVENTS,
    FIRST,
    FIRST_WEEKLY,
    LAYERS,
    REGISTERED,
    SECOND_WEEKLY,
    WEEKLY_COLUMNS,
    daily,
    with_,
)
from strataledger.plans import runs, verify
from strataledger.session import scratch_path
from strataledger.sources import feeds
from strataledger.sources.files import remove
from strataledger.sources.warehouse import Warehouse

# A merchant name that needs quoting in CSV, given to one merchant of the feed.
QUOTED = 'Joe "The, Grill" Co'
PLAIN_NAME = "m5"

# The published tables of an application's runs, by application and directory: the queries share them.
_published: dict[tuple[str, str], Warehouse] = {}


def write_files(spark: SparkSession, rows: DataFrame, entity: str, order: list[str], source: str, days: list[dt.date]) -> None:
    """One CSV file per day, also for days without rows. Rows are written by tasks; the driver only names files."""
    columns = [name for name in rows.columns if name not in ("date", *order)]
    staging = f"{source}-{entity}"
    dated = rows.repartition("date").sortWithinPartitions("date", *order).select(*columns, "date")
    dated.write.partitionBy("date").option("header", True).option("escape", '"').csv(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(source))
    for day in days:  # the calendar bounds them
        target = path(f"{source}/{entity}_{day}.csv")
        written = files.globStatus(path(f"{staging}/date={day}/part-*.csv"))
        if written:
            files.rename(written[0].getPath(), target)
        else:
            out = files.create(target)
            out.write(bytearray((",".join(columns) + "\n").encode()))
            out.close()
    remove(spark, staging)


def write_sources(layers, source: str) -> list[dt.date]:
    spark = layers.spark
    name = F.when(F.col("merchant_name") == PLAIN_NAME, F.lit(QUOTED)).otherwise(F.col("merchant_name"))
    sent = layers.bronze.select(*schemas.SOURCE_TRANSACTIONS.fieldNames(), "date", "_row_tag").withColumn("merchant_name", name)
    first, last = layers.bronze.agg(F.min("date"), F.max("date")).first()
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    write_files(spark, sent, "transactions", ["_row_tag"], source, days)
    accounts = layers.bronze_accounts.select(*schemas.SOURCE_ACCOUNTS.fieldNames(), "date")
    write_files(spark, accounts, "accounts", [], source, days)
    codes = layers.codes.withColumn("date", F.lit(str(first)).cast("date"))
    write_files(spark, codes, "transaction_codes", [], source, [first])
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.rename(path(f"{source}/transaction_codes_{first}.csv"), path(f"{source}/transaction_codes.csv"))
    return days


def published(layers) -> Warehouse:
    key = (layers.spark.sparkContext.applicationId, layers.sf_dir)
    if key not in _published:
        root = scratch_path(layers.spark, "runs")
        days = write_sources(layers, f"{root}/source")
        wh = Warehouse(layers.spark, f"{root}/tables", f"{root}/source")
        cut_day = dt.date.fromisoformat(feeds.FIRST_RUN_END)
        runs.historical(wh, str(days[0]), str(cut_day))
        runs.incremental(wh)
        runs.historical(wh, str(cut_day + dt.timedelta(days=2)), str(days[-1]))
        _published[key] = wh
    return _published[key]


def plain_names(rows: DataFrame) -> DataFrame:
    """The quoted name as the feed has it."""
    name = F.when(F.col("merchant_name") == QUOTED, F.lit(PLAIN_NAME)).otherwise(F.col("merchant_name"))
    return rows.withColumn("merchant_name", name)


@query(
    "run_bronze",
    with_(BRONZE)
    + f"SELECT {TXN_SQL}, date, 'transactions_' || strftime(date, '%Y-%m-%d') || '.csv' AS _source_file FROM bronze",
)
def run_bronze(layers):
    return txn_columns(plain_names(published(layers).dated("bronze/transactions")), "date", "_source_file")


@query(
    "run_silver",
    with_(*LAYERS)
    + f"""SELECT {TXN_SQL}, date, CAST(signed AS DOUBLE) AS _signed_amount, resolvable AS _is_resolvable,
          missing_merchant AS _missing_merchant_name FROM silver""",
)
def run_silver(layers):
    rows = plain_names(published(layers).dated("silver/transactions"))
    return doubles(txn_columns(rows, "date", "_signed_amount", "_is_resolvable", "_missing_merchant_name"), "_signed_amount")


@query(
    "run_quarantine",
    with_(*EVENTS) + f"SELECT {TXN_SQL}, date, reason AS _rejection_reason FROM classified WHERE reason IS NOT NULL",
)
def run_quarantine(layers):
    return txn_columns(plain_names(published(layers).dated("quarantine/transactions")), "date", "_rejection_reason")


@query(
    "run_accounts",
    with_(ACCOUNTS)
    + f"SELECT {ACC_SQL}, first_seen_date AS _first_seen_date, date AS _file_date FROM accounts JOIN first_seen USING (account_id)",
)
def run_accounts(layers):
    return acc_columns(published(layers).snapshot("silver/accounts"), "_first_seen_date", "_file_date")


@query(
    "run_daily",
    with_(*LAYERS, daily("daily", "silver", "(SELECT MIN(date) FROM bronze)", "(SELECT MAX(date) FROM bronze)"))
    + "SELECT * EXCLUDE (_source_period_start, _source_period_end) FROM daily",
)
def run_daily(layers):
    fields = []
    for kind in schemas.TRANSACTION_TYPES:
        for part, name in (("count", "count"), ("sum_signed_amount", "sum")):
            fields.append(F.col(f"transactions_by_type.{kind}.{part}").alias(f"{kind.lower()}_{name}"))
    unread = ("transactions_by_type", "_computed_at", "_pipeline_run_id", "_source_period_start", "_source_period_end")
    return published(layers).snapshot("gold/daily_summary").select("*", *fields).drop(*unread)


@query(
    "run_weekly",
    with_(*LAYERS, FIRST_WEEKLY, REGISTERED, SECOND_WEEKLY)
    + f"SELECT {WEEKLY_COLUMNS} FROM first_weekly UNION ALL SELECT {WEEKLY_COLUMNS} FROM second_weekly",
)
def run_weekly(layers):
    return published(layers).weekly().drop("_computed_at", "_pipeline_run_id")


@query(
    "run_log",
    with_(*LAYERS)
    + f"""SELECT model_name, strftime(day, '%Y-%m-%d') AS target_date, layer, 'SUCCESS' AS status,
          records_processed, records_written, records_rejected
          FROM (
            SELECT CAST(unnest(generate_series(CAST((SELECT MIN(date) FROM bronze) AS TIMESTAMP), CAST({END} AS TIMESTAMP),
                   INTERVAL 1 DAY)) AS DATE) AS day) days,
          LATERAL (
            SELECT 'bronze_accounts' AS model_name, 'BRONZE' AS layer, COUNT(*) AS records_processed,
                   COUNT(*) AS records_written, CAST(0 AS BIGINT) AS records_rejected
            FROM bronze_accounts WHERE date = day
            UNION ALL SELECT 'bronze_transactions', 'BRONZE', COUNT(*), COUNT(*), 0 FROM bronze WHERE date = day
            UNION ALL SELECT 'silver_transactions', 'SILVER', COUNT(*), COUNT(*) FILTER (WHERE reason IS NULL),
                   COUNT(*) FILTER (WHERE reason IS NOT NULL) FROM classified WHERE date = day
            UNION ALL SELECT 'silver_accounts', 'SILVER', COUNT(*) FILTER (WHERE date = day),
                   COUNT(DISTINCT account_id) FILTER (WHERE reason IS NULL AND date <= CASE
                     WHEN day <= {FIRST} THEN {FIRST} WHEN day = {FIRST} + 1 THEN day ELSE {END} END),
                   COUNT(*) FILTER (WHERE date = day AND reason IS NOT NULL) FROM classified_accounts) steps""",
)
def run_log(layers):
    """The log rows of all steps that have a file date, also of dates without rows."""
    return (
        published(layers)
        .appended("pipeline/run_log")
        .where("target_date is not null")
        .select("model_name", "target_date", "layer", "status", "records_processed", "records_written", "records_rejected")
    )


@query(
    "run_log_ends",
    with_(*LAYERS)
    + f""", runs AS (
            SELECT 'first' AS run, {FIRST} AS last UNION ALL SELECT 'increment', {FIRST} + 1 UNION ALL SELECT 'rest', {END}),
          weeks AS (SELECT week, MIN(last) AS last FROM silver, runs WHERE resolvable AND date <= last AND week + 6 <= last GROUP BY week)
          SELECT model_name, layer, 'SUCCESS' AS status, records_processed, records_written FROM (
            SELECT 'bronze_transaction_codes' AS model_name, 'BRONZE' AS layer,
                   CASE run WHEN 'first' THEN (SELECT COUNT(*) FROM codes) ELSE 0 END AS records_processed,
                   CASE run WHEN 'first' THEN (SELECT COUNT(*) FROM codes) ELSE 0 END AS records_written
            FROM runs WHERE run <> 'increment'
            UNION ALL SELECT 'silver_transaction_codes', 'SILVER', (SELECT COUNT(*) FROM codes), (SELECT COUNT(*) FROM codes)
            FROM runs WHERE run <> 'increment'
            UNION ALL SELECT 'gold_daily_summary', 'GOLD', (SELECT COUNT(*) FROM silver WHERE date <= last),
                   CAST(last - (SELECT MIN(date) FROM bronze) + 1 AS BIGINT) FROM runs
            UNION ALL SELECT 'gold_weekly_account_summary', 'GOLD',
                   (SELECT COUNT(*) FROM silver s JOIN weeks w ON s.week = w.week AND w.last = r.last WHERE resolvable AND date <= r.last),
                   (SELECT COUNT(DISTINCT (s.week, account_id)) FROM silver s JOIN weeks w ON s.week = w.week AND w.last <= r.last
                    WHERE resolvable AND date <= w.last) FROM runs r) steps""",
)
def run_log_ends(layers):
    """The log rows of the steps that a run takes once: codes and Gold."""
    return (
        published(layers)
        .appended("pipeline/run_log")
        .where("target_date is null")
        .select("model_name", "layer", "status", "records_processed", "records_written")
    )


def side_by_side(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row frames as one row: their union, with each column's only value."""
    both = one.unionByName(other, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


@query(
    "run_control",
    with_(*LAYERS)
    + f"""SELECT {END} AS last_processed_date, COUNT(*) AS weeks, MAX(week) AS last_week
          FROM (SELECT DISTINCT week FROM silver WHERE resolvable AND week + 6 <= {END})""",
)
def run_control(layers):
    """The watermark, and the registered weeks."""
    wh = published(layers)
    weeks = wh.appended("pipeline/weeks").agg(F.count(F.lit(1)).alias("weeks"), F.max("week_start_date").alias("last_week"))
    return side_by_side(wh.snapshot("pipeline/control").select("last_processed_date"), weeks)


@query(
    "run_verified",
    with_(BRONZE) + f"SELECT COUNT(DISTINCT date) AS dates, 38 AS checks, 0 AS violations FROM bronze WHERE date <= {END}",
)
def run_verified(layers):
    """All checks of the suite over the whole range of dates."""
    wh = published(layers)
    start, end = str(layers.bronze.agg(F.min("date")).first()[0]), layers.batch_end
    found = verify.suite(wh, start, end).agg(
        F.count(F.lit(1)).cast("int").alias("checks"), F.sum("violations").cast("int").alias("violations")
    )
    dates = wh.dated("bronze/transactions").where(F.col("date") <= cut(end)).agg(F.count_distinct("date").alias("dates"))
    return side_by_side(dates, found)


@query(
    "run_first_weeks",
    with_(*LAYERS, REGISTERED) + "SELECT week AS week_start_date, week + 6 AS week_end_date FROM registered",
)
def run_first_weeks(layers):
    """Weeks that the first run registered."""
    weeks = published(layers).appended("pipeline/weeks").where(F.col("week_end_date") <= cut(feeds.FIRST_RUN_END))
    return weeks.select("week_start_date", "week_end_date")
