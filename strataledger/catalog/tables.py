"""Registered queries that publish tables and read them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strataledger.catalog.control import cut
from strataledger.catalog.registry import query
from strataledger.catalog.silver import ACC_SQL, TXN_SQL, acc_columns, txn_columns
from strataledger.catalog.sql_layers import ACCOUNTS, BRONZE, END, EVENTS, FIRST, LAYERS, with_
from strataledger.functions.rules import INVALID_CHANNEL
from strataledger.operators import accounts as acc
from strataledger.plans import control
from strataledger.schemas import BRONZE_TRANSACTIONS, POSITION
from strataledger.session import scratch_path
from strataledger.sources import feeds
from strataledger.sources.warehouse import Warehouse
from strataledger.streaming.file_stream import append_new_dates


def warehouse(layers) -> Warehouse:
    return Warehouse(layers.spark, scratch_path(layers.spark, "warehouse"), layers.sf_dir)


@query(
    "table_partition_replace",
    with_(*EVENTS)
    + f"""SELECT {TXN_SQL}, date, reason AS _rejection_reason FROM classified
          WHERE reason IS NOT NULL AND (date <> {FIRST} OR reason = 'INVALID_CHANNEL')""",
)
def table_partition_replace(layers):
    """All quarantine partitions are published; then one date is published again with fewer rows."""
    wh = warehouse(layers)
    rows = layers.staged(layers.quarantine.hint("rebalance", "date"), "quarantine")
    dates = [row[0] for row in rows.select("date").distinct().collect()]  # bounded by the calendar
    wh.publish_partitions(rows, "quarantine/transactions", "date", dates)
    day = dt.date.fromisoformat(feeds.FIRST_RUN_END)
    again = rows.where((F.col("date") == cut(feeds.FIRST_RUN_END)) & (F.col("_rejection_reason") == INVALID_CHANNEL))
    wh.publish_partitions(again, "quarantine/transactions", "date", [day])
    return txn_columns(wh.dated("quarantine/transactions"), "date", "_rejection_reason")


@query(
    "table_snapshot_replace",
    with_(ACCOUNTS)
    + f"SELECT {ACC_SQL}, first_seen_date AS _first_seen_date FROM accounts JOIN first_seen USING (account_id)",
)
def table_snapshot_replace(layers):
    """The account snapshot of the first run, then the next version made from it and the delta."""
    wh = warehouse(layers)
    passing = layers.passing_accounts
    first = acc.incoming_accounts(layers.up_to(passing, feeds.FIRST_RUN_END))
    wh.publish_snapshot(first, "silver/accounts", "first")
    delta = acc.incoming_accounts(passing.where(F.col("date") > cut(feeds.FIRST_RUN_END)))
    wh.publish_snapshot(acc.upsert(wh.snapshot("silver/accounts"), delta), "silver/accounts", "second")
    return acc_columns(wh.snapshot("silver/accounts"), "_first_seen_date")


@query(
    "table_week_registry",
    with_(*LAYERS)
    + f"""SELECT DISTINCT week AS week_start_date, week + 6 AS week_end_date,
          CASE WHEN week + 6 <= {FIRST} THEN 'first' ELSE 'second' END AS computed_by_run_id
          FROM silver WHERE resolvable AND week + 6 <= {END}""",
)
def table_week_registry(layers):
    """Weeks of two runs, appended; earlier entries stay."""
    wh = warehouse(layers)
    for run_id, weeks in (("first", layers.first_weeks), ("second", layers.second_weeks)):
        control.record_weeks(wh, [tuple(row) for row in weeks.collect()], run_id)
    return wh.appended("pipeline/weeks").drop("computed_at")


def bronze_form(rows):
    """Feed rows with the columns of the bronze table; the feed's row tag is their position."""
    placed = rows.withColumn("_source_position", F.col("_row_tag").cast(POSITION))
    return placed.select(*BRONZE_TRANSACTIONS.fieldNames())


@query(
    "table_write_once",
    with_(BRONZE) + f"SELECT {TXN_SQL}, date FROM bronze",
)
def table_write_once(layers):
    """Dates up to the first run are loaded, then all dates: loaded ones are skipped."""
    wh = warehouse(layers)
    rows = bronze_form(layers.bronze)
    write = append_new_dates(wh, "transactions", "run")
    write(layers.up_to(rows, feeds.FIRST_RUN_END), 0)
    write(rows, 1)
    return txn_columns(wh.dated("bronze/transactions"), "date")


@query(
    "stream_bronze",
    with_(BRONZE) + f"SELECT {TXN_SQL}, date FROM bronze",
)
def stream_bronze(layers):
    """The event file as a stream, ingested to bronze until nothing is left."""
    wh = warehouse(layers)
    events = feeds.event_stream(layers.spark, layers.sf_dir)
    stream = bronze_form(feeds.event_transactions(layers.spark, layers.sf_dir, events=events))
    running = (
        stream.writeStream.foreachBatch(append_new_dates(wh, "transactions", "run"))
        .option("checkpointLocation", scratch_path(layers.spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return txn_columns(wh.dated("bronze/transactions"), "date")
