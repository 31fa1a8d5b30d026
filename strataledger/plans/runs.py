"""Runs: a range of file dates, or the next file date after the watermark."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from strataledger import schemas
from strataledger.functions.audit import new_run_id
from strataledger.functions.dates import days_between
from strataledger.operators.runlog import CODE_STEPS, DATE_STEPS, GOLD_STEPS, skipped_steps
from strataledger.operators.transactions import SCOPE_BATCH
from strataledger.plans import control, steps
from strataledger.plans.steps import Batch
from strataledger.sources.files import missing_sources, source_dates
from strataledger.sources.warehouse import Warehouse, now


@dataclass
class RunLog:
    """Log rows of one run, one per (step, file date); a later entry replaces an earlier one. Their
    number is bounded by steps times dates. They are appended once, when the run ends."""

    run_id: str
    rows: dict = field(default_factory=dict)

    def add(self, model, layer, status, date=None, started=None, processed=None, written=None, rejected=None, error=None):
        key = (model, str(date) if date else None)
        finished = now().isoformat() if started else None
        self.rows[key] = (
            self.run_id, model, key[1], layer, started, finished, status, processed, written, rejected, error,
        )

    def has(self, model, date=None) -> bool:
        return (model, str(date) if date else None) in self.rows

    def flush(self, wh: Warehouse) -> None:
        wh.append("pipeline/run_log", list(self.rows.values()), self.run_id)
        self.rows = {}


@dataclass
class RunOptions:
    dup_scope: str = SCOPE_BATCH
    daily_bounds: str = steps.PROCESSED
    balance_at: str = steps.RUN_END
    # File dates per batch; None takes the whole range as one set-based batch.
    days_per_batch: int | None = None


def historical(wh: Warehouse, start: str, end: str, options: RunOptions | None = None) -> str:
    """Load codes and all file dates of a range, then Gold once. Returns the run id."""
    options = options or RunOptions()
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if first > last:
        raise ValueError("start must not be after end")
    gaps = sorted(f"{row[0]}_{row[1]}.csv" for row in missing_sources(wh.spark, wh.source, start, end).collect())
    if gaps:
        raise ValueError(f"missing source files: {', '.join(gaps)}")
    run_id = new_run_id()
    log = RunLog(run_id)
    read_control(wh, log)
    with_codes(wh, log)
    size = options.days_per_batch or (last - first).days + 1
    day = first
    while day <= last:
        until = min(day + dt.timedelta(days=size - 1), last)
        run_batch(wh, Batch(day, until, run_id), last, log, options)
        day = until + dt.timedelta(days=1)
    finish(wh, last, log, options)
    return run_id


def arrived_after(wh: Warehouse, mark: dt.date) -> list[dt.date]:
    """File dates that follow the watermark without a gap and have both files; the calendar bounds them."""
    accounts, transactions = (source_dates(wh.spark, wh.source, entity) for entity in ("accounts", "transactions"))
    both = accounts.join(transactions, "date", "left_semi").where(F.col("date") > F.lit(mark))
    present, days = {row[0] for row in both.collect()}, []
    while (day := mark + dt.timedelta(days=len(days) + 1)) in present:
        days.append(day)
    return days


def incremental(wh: Warehouse, options: RunOptions | None = None, most: int | None = 1) -> str | None:
    """The file date after the watermark, or up to ``most`` of them (None: all) as one batch. None when a
    file of the next date has not arrived."""
    options = options or RunOptions()
    log = RunLog(new_run_id())
    mark = read_control(wh, log)
    if mark is None:
        raise RuntimeError("no watermark: run a historical range first")
    days = arrived_after(wh, mark)[:most]
    if not days:
        return None
    run_batch(wh, Batch(days[0], days[-1], log.run_id), days[-1], log, options)
    finish(wh, days[-1], log, options)
    return log.run_id


def read_control(wh: Warehouse, log: RunLog) -> dt.date | None:
    """The watermark. Notes a run that lost its log; state that cannot be read leaves a FAILED row and halts."""
    try:
        wh.refresh()
        mark = control.get_watermark(wh)
        for row in control.lost_run_entries(wh, log.run_id):
            log.add(row["model_name"], row["layer"], row["status"], error=row["error_message"])
    except Exception as error:
        log.add("CONTROL_PLANE", "ORCHESTRATION", "FAILED", error=f"control state: {error}")
        log.flush(wh)
        raise
    return mark


def with_codes(wh: Warehouse, log: RunLog) -> None:
    started = now().isoformat()
    try:
        bronze, silver = steps.load_codes(wh, log.run_id)
    except Exception as error:
        log.add("silver_transaction_codes", "SILVER", "FAILED", error=str(error))
        for model, layer in DATE_STEPS + GOLD_STEPS:
            log.add(model, layer, "SKIPPED")
        log.flush(wh)
        raise
    for (model, layer), written in zip(CODE_STEPS, (bronze, silver)):
        log.add(model, layer, "SUCCESS", started=started, processed=written, written=written)


def run_batch(wh: Warehouse, batch: Batch, last: dt.date, log: RunLog, options: RunOptions) -> None:
    """Accounts before transactions, so accounts of the same file date count as known."""
    model = DATE_STEPS[0][0]
    try:
        started = now().isoformat()
        loaded, broken = steps.load_bronze(wh, batch, "accounts", schemas.SOURCE_ACCOUNTS)
        for d in batch.dates:
            log.add(model, "BRONZE", "SUCCESS", d, started, loaded[d] + broken[d], loaded[d], broken[d])
        model, started = "silver_accounts", now().isoformat()
        total, read, rejected = steps.promote_accounts(wh, batch)
        for d in batch.dates:
            log.add(model, "SILVER", "SUCCESS", d, started, read[d], total, rejected[d])
        model, started = "bronze_transactions", now().isoformat()
        loaded, broken = steps.load_bronze(wh, batch, "transactions", schemas.SOURCE_TRANSACTIONS)
        for d in batch.dates:
            log.add(model, "BRONZE", "SUCCESS", d, started, loaded[d] + broken[d], loaded[d], broken[d])
        model, started = "silver_transactions", now().isoformat()
        kept, rejected = steps.promote_transactions(wh, batch, options.dup_scope)
        for d in batch.dates:
            log.add(model, "SILVER", "SUCCESS", d, started, kept[d] + rejected[d], kept[d], rejected[d])
    except Exception as error:
        skip_after(wh, log, batch, last, model, error)
        log.flush(wh)
        raise


def skip_after(wh: Warehouse, log: RunLog, batch: Batch, last: dt.date, model: str, error: Exception) -> None:
    """The failed step on every date of its batch; all steps not reached are SKIPPED."""
    layers = dict(DATE_STEPS)
    for d in batch.dates:
        log.add(model, layers[model], "FAILED", d, error=str(error))
    days = days_between(wh.spark, str(batch.start), str(last))
    # One row per step and day of the range.
    for row in skipped_steps(days, str(batch.start), model).collect():
        if not log.has(row["model_name"], row["target_date"]):
            log.add(row["model_name"], row["layer"], row["status"], row["target_date"])


def finish(wh: Warehouse, last: dt.date, log: RunLog, options: RunOptions) -> None:
    """Gold, then the week registry, then the watermark, then the log."""
    started = now().isoformat()
    daily = weekly = None
    try:
        weeks = [tuple(row) for row in steps.open_weeks(wh, last).select("week_start_date", "week_end_date").collect()]
        daily = steps.publish_daily(wh, log.run_id, options.daily_bounds)
        weekly = steps.publish_weekly(wh, sorted(weeks), log.run_id, options.balance_at)
    except Exception as error:
        failed = GOLD_STEPS[0] if daily is None else GOLD_STEPS[1]
        log.add(*GOLD_STEPS[1], "SKIPPED")
        log.add(*failed, "FAILED", error=str(error))
        log.flush(wh)
        raise
    read_daily, read_weekly = steps.rows_behind_gold(wh, sorted(weeks))
    log.add(*GOLD_STEPS[0], "SUCCESS", started=started, processed=read_daily, written=daily)
    log.add(*GOLD_STEPS[1], "SUCCESS", started=started, processed=read_weekly, written=weekly)
    try:
        control.record_weeks(wh, sorted(weeks), log.run_id)
        control.advance_watermark(wh, last, log.run_id)
    except Exception as error:
        log.add("CONTROL_PLANE", "ORCHESTRATION", "FAILED", error=f"control tables: {error}")
        log.flush(wh)
        raise
    log.flush(wh)


def log_of(wh: Warehouse, run_id: str):
    return wh.appended("pipeline/run_log").where(F.col("run_id") == run_id)
