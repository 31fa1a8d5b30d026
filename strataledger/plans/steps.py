"""The steps of a batch, each over a whole range of file dates at once."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataledger import schemas
from strataledger.operators import accounts as acc
from strataledger.operators import daily as dly
from strataledger.operators import transactions as txn
from strataledger.operators import weekly as wk
from strataledger.operators.checks import duplicate_keys
from strataledger.sources.files import BROKEN, bronze_rows, remove, whole_rows
from strataledger.sources.warehouse import Change, Warehouse, now, within

PROCESSED, SILVER = "processed", "silver"
RUN_END, WEEK_END = "run_end", "week_end"


@dataclass
class Batch:
    """One range of file dates under one run id."""

    start: dt.date
    end: dt.date
    run_id: str
    dates: list[dt.date] = field(init=False)

    def __post_init__(self):
        self.dates = [self.start + dt.timedelta(days=i) for i in range((self.end - self.start).days + 1)]

    @property
    def bounds(self) -> tuple[str, str]:
        return str(self.start), str(self.end)


class DataQualityError(RuntimeError):
    """A check before publishing failed; nothing was published."""


def by_partition(rows: DataFrame, column: str, partitions: int) -> DataFrame:
    """Bring the rows of an output partition together, so that not every task writes a file to each.
    AQE splits hot partitions and joins small ones. A single partition needs no shuffle."""
    return rows.hint("rebalance", column) if partitions > 1 else rows


def write_bronze(wh: Warehouse, change: Change, rows: DataFrame, entity: str, dates: list[dt.date], run_id: str) -> tuple[dict, dict]:
    """Write source rows of some dates within a change, sound and broken ones in one pass; returns the rows of both per date."""
    if wh.strict:
        rows = whole_rows(rows).withColumn(BROKEN, F.lit(None).cast("string"))
    folder = change.folder(f"bronze/{entity}")
    sides = [(broken, day) for broken in (False, True) for day in dates]
    counts = wh.counted_write(rows.withColumn("_broken", F.col(BROKEN).isNotNull()), folder, ["_broken", "date"], sides)
    sound, broken = ({day: counts[(side, day)] for day in dates} for side in (False, True))
    change.place(f"bronze/{entity}", f"{folder}/_broken=false", sound)
    change.place(f"bronze/broken_{entity}", f"{folder}/_broken=true", broken)
    change.append("pipeline/loads", [(entity, day, run_id, sound[day], broken[day], now()) for day in dates])
    return sound, broken


def load_bronze(wh: Warehouse, batch: Batch, entity: str, schema: StructType) -> tuple[dict, dict]:
    """Ingest the files of the batch that are not loaded yet, all dates in one job; returns sound and broken rows per date.

    Partitions and load rows become current in one commit, so a date is loaded wholly or not at all.
    """
    done = {
        row[0]
        for row in within(wh.appended("pipeline/loads").where(F.col("entity") == entity), *batch.bounds)
        .select("date")
        .collect()
    }
    todo = [d for d in batch.dates if d not in done]
    none = {d: 0 for d in batch.dates}
    if not todo:
        return none, none
    paths = [f"{wh.source}/{entity}_{d}.csv" for d in todo]
    # No shuffle: every split belongs to one file, so to one date.
    rows = bronze_rows(wh.spark, paths, schema, batch.run_id, wh.multiline)
    change = wh.change(batch.run_id)
    try:
        sound, broken = write_bronze(wh, change, rows, entity, todo, batch.run_id)
        change.commit()
    except BaseException:
        change.abandon()
        raise
    return none | sound, none | broken


def load_codes(wh: Warehouse, run_id: str) -> tuple[int, int]:
    """Ingest the code list once and promote it. A repeated code would multiply rows, so it fails."""
    written = 0
    if not wh.has_snapshot("bronze/transaction_codes"):
        # Rows depend on the whole code list, so a broken row in it fails the load.
        read = bronze_rows(wh.spark, [f"{wh.source}/transaction_codes.csv"], schemas.SOURCE_CODES, run_id, wh.multiline)
        rows = whole_rows(read).drop("date", "_source_position")
        written = wh.publish_snapshot(rows, "bronze/transaction_codes", run_id)
    codes = acc.promote_codes(wh.snapshot("bronze/transaction_codes"))
    repeated = duplicate_keys(codes.where("transaction_code IS NOT NULL"), ["transaction_code"]).limit(5).collect()
    if repeated:
        raise DataQualityError(f"transaction codes repeat: {[row[0] for row in repeated]}")
    return written, wh.publish_snapshot(codes, "silver/transaction_codes", run_id)


def promote_accounts(wh: Warehouse, batch: Batch) -> tuple[int, dict, dict]:
    """Upsert the accepted account rows of the batch and quarantine the others per file date, in one commit. Only the
    buckets of the batch's accounts are read and rewritten. Returns the size of the snapshot, and rows read and
    rejected per date."""
    bronze = wh.dated_with_position("bronze/accounts", *batch.bounds)
    read = wh.rows_of("bronze/accounts", batch.dates)
    classified = acc.classify_accounts(bronze)
    change, path = wh.change(batch.run_id), None
    try:
        rejects = by_partition(acc.rejected_accounts(classified), "date", len(batch.dates))
        rejected = change.parts(rejects, "quarantine/accounts", "date", batch.dates)
        incoming, path = wh.stage(acc.incoming_accounts(acc.passing(classified), "_row_tag"), "incoming-accounts")
        touched = [row[0] for row in incoming.select(wh.bucket()).distinct().collect()]  # no more than there are buckets
        total = wh.write_accounts(change, acc.upsert(wh.accounts_in(touched), incoming), touched)
        change.commit()
    except BaseException:
        change.abandon()
        raise
    finally:
        if path:
            remove(wh.spark, path)
    return total, read, rejected


def promote_transactions(wh: Warehouse, batch: Batch, dup_scope: str = txn.SCOPE_BATCH) -> tuple[dict, dict]:
    """Classify, sign and flag all rows of the batch, check the accounting, then make both outputs current.

    Every row is written once, to a new folder with an accepted and a rejected side, and counted on the way. If
    bronze = accepted + rejected holds for every date, measures and accepted ids are written beside it, and one
    commit makes silver, quarantine, measures and ids of the batch current together.
    """
    scratch: list[str] = []
    change = wh.change(batch.run_id)
    try:
        return _promote_transactions(wh, batch, dup_scope, change, scratch)
    except BaseException:
        change.abandon()
        raise
    finally:
        for folder in scratch:
            remove(wh.spark, folder)


def _promote_transactions(wh: Warehouse, batch: Batch, dup_scope: str, change: Change, scratch: list[str]) -> tuple[dict, dict]:
    bronze = wh.dated_with_position("bronze/transactions", *batch.bounds)

    def stage(rows: DataFrame, name: str) -> DataFrame:
        table, path = wh.stage(rows, name)
        scratch.append(path)
        return table

    codes = wh.snapshot("silver/transaction_codes")
    classified = txn.classify(bronze, codes, wh.accepted_ids(without=batch.dates), dup_scope, stage=stage)
    resolved = txn.resolve(classified, wh.snapshot("silver/accounts"))
    rows = by_partition(txn.settled(resolved, batch.run_id), "date", len(batch.dates))
    folder = change.folder(wh.SETTLED)
    sides = [(side, day) for side in (True, False) for day in batch.dates]
    counts = wh.counted_write(rows, folder, ["_accepted", "date"], sides)
    accepted, rejected = ({day: counts[(side, day)] for day in batch.dates} for side in (True, False))
    read = wh.rows_of("bronze/transactions", batch.dates)
    open_dates = {str(day): n for day, n in read.items() if n != accepted[day] + rejected[day]}
    if open_dates:
        raise DataQualityError(f"bronze rows != silver + quarantine rows on {open_dates}")
    change.place("silver/transactions", f"{folder}/_accepted=true", accepted)
    change.place("quarantine/transactions", f"{folder}/_accepted=false", rejected)
    sides_written = [f"{folder}/_accepted=true"] if any(accepted.values()) else []
    silver = wh.read(schemas.SILVER_TRANSACTIONS, wh.SETTLED, sides_written)
    measures = dly.daily_partials(silver, codes, ("date", "transaction_date"))
    change.parts(by_partition(measures, "date", len(batch.dates)), wh.PARTIALS, "date", batch.dates)
    wh.write_ledger(change, silver, accepted)
    change.commit()
    while wh.merge_ledger(batch.run_id):
        pass
    return accepted, rejected


def daily_measures(wh: Warehouse) -> DataFrame:
    """Stored measures per (file date, transaction date): small, bounded by the calendar."""
    return wh.partials(schemas.DAILY_MEASURES)


def rows_behind_gold(wh: Warehouse, weeks: list[tuple]) -> tuple[int, int]:
    """Silver rows behind the daily summary, and resolvable ones behind the given weeks."""
    in_weeks = F.trunc("transaction_date", "week").isin([start for start, _ in weeks])
    measured = daily_measures(wh).agg(
        F.coalesce(F.sum("silver_rows"), F.lit(0)), F.coalesce(F.sum(F.when(in_weeks, F.col("total_transactions"))), F.lit(0))
    )
    return tuple(measured.first())


def open_weeks(wh: Warehouse, through: dt.date) -> DataFrame:
    """Complete weeks with resolvable rows that the registry does not name."""
    dates = daily_measures(wh).where(F.col("total_transactions") > 0).select("transaction_date")
    return wk.uncomputed_weeks(dates, wh.appended("pipeline/weeks"), str(through))


def publish_daily(wh: Warehouse, run_id: str, bounds: str = PROCESSED) -> int:
    """Rebuild the daily summary from the stored measures; silver history is not read again."""
    processed = None
    if bounds == PROCESSED:
        processed = wh.appended("pipeline/loads").where(F.col("entity") == "transactions")
    days = dly.added_days(daily_measures(wh), processed)
    return wh.publish_snapshot(dly.gold_daily(dly.dense_days(days), run_id), "gold/daily_summary", run_id)


def publish_weekly(wh: Warehouse, weeks: list[tuple], run_id: str, balance_at: str = RUN_END) -> int:
    """Compute the given weeks and replace exactly their partitions; other weeks are not touched.

    The stored measures tell which file dates hold rows of these weeks, late ones included, so only
    those silver partitions are read.
    """
    if weeks:
        starts = [start for start, _ in weeks]
        targets = wh.frame(weeks, schemas.WEEKS)
        in_weeks = F.trunc("transaction_date", "week").isin(starts) & (F.col("total_transactions") > 0)
        file_dates = [row[0] for row in daily_measures(wh).where(in_weeks).select("date").distinct().collect()]
        silver = wh.dated("silver/transactions").where(F.col("date").isin(file_dates))
        measures = wk.weekly_measures_of(silver, wh.snapshot("silver/transaction_codes"), targets)
        if balance_at == WEEK_END:
            bronze = wh.dated("bronze/accounts").where(F.col("date") <= F.lit(str(max(end for _, end in weeks))))
            passing = acc.passing(acc.classify_accounts(bronze))
            summary = wk.with_week_end_balance(measures, acc.balances_at_week_end(passing, measures))
        else:
            summary = wk.with_run_end_balance(measures, wh.snapshot("silver/accounts"))
        rows = by_partition(wk.gold_weekly(summary, run_id), "week_start_date", len(weeks))
        wh.publish_partitions(rows, wh.WEEKLY, "week_start_date", starts, run_id)
    return sum(rows for _, rows in wh.state.parts.get(wh.WEEKLY, {}).values())
