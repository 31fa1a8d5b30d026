"""Transaction, account and code feeds derived from the star-schema and event test tables.

Each function maps whole tables to the bronze layout (source columns, file ``date``, audit columns),
so the same operators run on them as on ingested files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataledger.schemas import MONEY

# Fixed values of the feed: account files arrive on these dates, the first run ends on this date. The
# second run ends with the last file that the events give.
ACCOUNT_DATES = ("2024-01-01", "2024-01-10", "2024-01-16", "2024-01-25")
FIRST_RUN_END = "2024-01-21"


# Stated schemas: no job is spent on reading them from a file.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a file stream."""
    reader = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def audited(df: DataFrame, entity: str) -> DataFrame:
    date_text = F.date_format("date", "yyyy-MM-dd")
    return df.withColumns(
        {
            "_source_file": F.concat(F.lit(f"{entity}_"), date_text, F.lit(".csv")),
            "_ingested_at": F.to_timestamp("date"),
            "_pipeline_run_id": F.concat(F.lit("run-"), date_text),
        }
    )


def event_transactions(
    spark: SparkSession, sf_dir: str, same_day_copies: bool = False, events: DataFrame | None = None
) -> DataFrame:
    """``events`` as card transactions.

    Some events are sent again with a valid channel: in a file of the next four days, or in the same
    file when ``same_day_copies`` is set. Half of them had an invalid channel at first, so they are
    accepted late. ``_row_tag`` is the position of a row in its file. ``events`` may be a stream of
    the same table.
    """
    events = (table(spark, sf_dir, "events") if events is None else events).select(
        "event_id",
        F.to_date("ts").alias("day"),
        "user_id",
        "event_type",
        (F.col("value").cast(MONEY) - F.lit(2)).cast(MONEY).alias("amount"),
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
    )
    resent = F.col("event_id") % 50 == 0
    sends = F.when(resent, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    again = F.col("send") == 1
    k = F.col("k")
    channel = F.when((k % 10 == 9) | (resent & (k % 2 == 1)), "DRIVE_THRU").when(k % 2 == 0, "ONLINE").otherwise("IN_STORE")
    delay = F.col("send") * (F.lit(1) + F.floor(F.col("event_id") / 50) % 4)
    file_date = F.col("day") if same_day_copies else F.date_add("day", delay.cast("int"))
    rows = events.withColumn("send", F.explode(sends)).select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.when(again | (k != 0), F.col("user_id").cast("string")).alias("account_id"),
        F.col("day").alias("transaction_date"),
        "amount",
        F.col("event_type").alias("transaction_code"),
        F.when(again | (k % 7 != 0), F.concat(F.lit("m"), k.cast("string"))).alias("merchant_name"),
        F.when(again, "ONLINE").otherwise(channel).alias("channel"),
        file_date.alias("date"),
        (F.col("event_id") * 2 + F.col("send")).alias("_row_tag"),
    )
    return audited(rows, "transactions")


def event_codes(spark: SparkSession) -> DataFrame:
    """Reference list for ``events``; a literal relation, so its size is known to the planner."""
    return spark.sql(
        """
        SELECT * FROM VALUES
          ('purchase', 'Purchase', 'DR', 'PURCHASE', true),
          ('signup', 'Payment', 'CR', 'PAYMENT', true),
          ('view', 'Annual fee', 'DR', 'FEE', true),
          ('click', 'Interest charge', 'DR', 'INTEREST', true)
        AS t(transaction_code, description, debit_credit_indicator, transaction_type, affects_balance)
        """
    )


def event_codes_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze reference rows for the codes that ``events`` really uses."""
    used = table(spark, sf_dir, "events").select(F.col("event_type").alias("transaction_code")).distinct()
    return event_codes(spark).join(used, "transaction_code", "left_semi").withColumns(
        {
            "_source_file": F.lit("transaction_codes.csv"),
            "_ingested_at": F.lit("2024-01-01 00:00:00").cast("timestamp"),
            "_pipeline_run_id": F.lit("run-2024-01-01"),
        }
    )


def customer_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as account files: a first file, late arrivals and two delta files.

    Some statuses and some balances are invalid, so both account rules have rows.
    """
    status = (
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "ACTIVE")
        .when(F.col("c_mktsegment") == "FURNITURE", "SUSPENDED")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "CLOSED")
        .otherwise(F.col("c_mktsegment"))
    )
    first = F.when(F.col("c_nationkey") < 20, F.lit(0)).otherwise(F.lit(1))
    files = F.array_compact(
        F.array(
            first,
            F.when(F.col("c_custkey") % 3 == 0, F.lit(2)),
            F.when(F.col("c_custkey") % 5 == 0, F.lit(3)),
        )
    )
    dates = F.array(*[_day(d) for d in ACCOUNT_DATES])
    raised = (
        F.when(F.col("file") == 2, F.lit(10)).when(F.col("file") == 3, F.lit(20)).otherwise(F.lit(0)).cast(MONEY)
    )
    balance = F.when(F.col("c_acctbal") >= -900, (F.col("c_acctbal").cast(MONEY) + raised).cast(MONEY))
    rows = (
        table(spark, sf_dir, "customer")
        .withColumn("file", F.explode(files))
        .select(
            F.col("c_custkey").cast("string").alias("account_id"),
            F.col("c_name").alias("customer_name"),
            status.alias("account_status"),
            (F.lit(5000) + F.col("c_nationkey") * 100).cast(MONEY).alias("credit_limit"),
            balance.alias("current_balance"),
            F.date_add(_day("2020-01-01"), (F.col("c_custkey") % 1000).cast("int")).alias("open_date"),
            _day("2024-01-01").alias("billing_cycle_start"),
            _day("2024-01-31").alias("billing_cycle_end"),
            F.element_at(dates, F.col("file") + 1).alias("date"),
        )
    )
    return audited(rows, "accounts")


def order_codes(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """
        SELECT * FROM VALUES
          ('O', 'Open order', 'DR', 'PURCHASE', true),
          ('F', 'Filled order', 'CR', 'PAYMENT', true),
          ('P', 'Pending order', 'DR', 'FEE', true)
        AS t(transaction_code, description, debit_credit_indicator, transaction_type, affects_balance)
        """
    )


def lineitem_codes(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """
        SELECT * FROM VALUES
          ('N', 'Sale', 'DR', 'PURCHASE', true),
          ('R', 'Return', 'CR', 'PAYMENT', true),
          ('A', 'Adjustment', 'DR', 'INTEREST', true)
        AS t(transaction_code, description, debit_credit_indicator, transaction_type, affects_balance)
        """
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as card transactions, for volume over several years of days and weeks."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderstatus").alias("transaction_code"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("merchant_name"),
        F.when(F.col("o_orderpriority") < "3", "ONLINE").otherwise("IN_STORE").alias("channel"),
        F.to_date("o_orderdate").alias("date"),
    )
    return audited(rows, "orders")


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as card transactions of the customer who placed the order."""
    buyers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("account_id")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(buyers, "l_orderkey", "left")
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
                "transaction_id"
            ),
            "account_id",
            F.to_date("l_shipdate").alias("transaction_date"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.col("l_returnflag").alias("transaction_code"),
            F.col("l_linestatus").alias("merchant_name"),
            F.when(F.col("l_linestatus") == "O", "ONLINE").otherwise("IN_STORE").alias("channel"),
            F.to_date("l_shipdate").alias("date"),
        )
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(lineitem_rows(spark, sf_dir), "lineitem")
