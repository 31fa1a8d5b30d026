"""Control state: watermark, week registry, lost runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strataledger.operators.runlog import checked_control, lost_run_rows, lost_runs
from strataledger.sources.warehouse import Warehouse, now


def get_watermark(wh: Warehouse) -> dt.date | None:
    """Last processed file date, or None before the first run; a malformed control table fails."""
    row = checked_control(wh.snapshot("pipeline/control")).select("last_processed_date").first()
    return row[0] if row else None


def advance_watermark(wh: Warehouse, day: dt.date, run_id: str) -> None:
    """Replace the control row. Called last, after Gold and the week registry. An older range that runs
    again leaves the date where it is."""
    day = max(day, get_watermark(wh) or day)
    row = wh.frame([(day, now(), run_id)], wh.SNAPSHOT["pipeline/control"])
    wh.publish_snapshot(row, "pipeline/control", run_id)


def computed_weeks(wh: Warehouse) -> set[dt.date]:
    return {row[0] for row in wh.appended("pipeline/weeks").select("week_start_date").distinct().collect()}


def record_weeks(wh: Warehouse, weeks: list[tuple], run_id: str) -> None:
    """Append weeks to the registry; an empty list does nothing."""
    wh.append("pipeline/weeks", [(start, end, now(), run_id) for start, end in weeks], run_id)


def lost_run_entries(wh: Warehouse, run_id: str) -> list:
    """Log rows for the run that wrote the control row but no log; a malformed control table fails."""
    control = checked_control(wh.snapshot("pipeline/control"))
    return lost_run_rows(lost_runs(control, wh.appended("pipeline/run_log")), run_id).collect()


def latest_registered_week(wh: Warehouse):
    return wh.appended("pipeline/weeks").orderBy(F.desc("week_start_date")).limit(1)


def recent_log(wh: Warehouse, n: int = 5):
    """The n latest log rows."""
    return wh.appended("pipeline/run_log").orderBy(F.desc("started_at")).limit(n)
