"""Arrival of source files as a stream: bronze first, then the same batch steps per file date.

There is no event-time state. Duplicates are searched in the whole history, so they are looked up in
the silver table inside ``foreachBatch`` rather than in a stream state that would grow for ever.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strataledger.functions.audit import new_run_id
from strataledger.plans import control, runs
from strataledger.plans.steps import write_bronze
from strataledger.sources.files import BROKEN, audited_rows, csv_options, csv_rows, remove, scanned
from strataledger.sources.warehouse import Warehouse, now


def arriving_rows(wh: Warehouse, entity: str, schema: StructType) -> DataFrame:
    """New source files as a stream of text rows; positions are computed per micro-batch, in the scan's order."""
    reader = csv_options(wh.spark.readStream, schema, wh.multiline).option("pathGlobFilter", f"{entity}_*.csv")
    return scanned(reader.csv(wh.source))


def append_new_dates(wh: Warehouse, entity: str, run_id: str):
    """``foreachBatch`` writer. Rows, load rows and log rows become current in one commit, and dates already loaded are
    skipped, so a batch that is repeated after a crash at any point changes nothing."""

    def write(rows: DataFrame, batch_id: int) -> None:
        wh.refresh()  # runs may have committed since the last batch
        loaded = wh.appended("pipeline/loads").where(F.col("entity") == entity).select("date")
        # The calendar bounds the loaded dates. Dates are brought together before they are written.
        if BROKEN not in rows.columns:  # rows that come from no text
            rows = rows.withColumn(BROKEN, F.lit(None).cast("string"))
        fresh = rows.join(F.broadcast(loaded), "date", "left_anti").hint("rebalance", "date")
        staged, path = wh.stage(fresh, f"stream-{entity}")
        change = wh.change(run_id)
        try:
            days = [row[0] for row in staged.select("date").distinct().collect()]
            if days:
                started = now().isoformat()
                sound, broken = write_bronze(wh, change, staged.hint("rebalance", "date"), entity, days, run_id)
                # The rows carry this run's id, so the log must know it.
                log = runs.RunLog(run_id)
                for day in days:
                    read = sound[day] + broken[day]
                    log.add(f"bronze_{entity}", "BRONZE", "SUCCESS", day, started, read, sound[day], broken[day])
                change.append("pipeline/run_log", list(log.rows.values()))
                change.commit()
        except BaseException:
            change.abandon()
            raise
        finally:
            remove(wh.spark, path)

    return write


def ingest_available(wh: Warehouse, entity: str, schema: StructType, checkpoint: str) -> StreamingQuery:
    """Ingest every file that has arrived since the last call, then stop. The checkpoint folder
    remembers the files; it must lie in storage that all executors share."""
    run_id = new_run_id()
    append = append_new_dates(wh, entity, run_id)

    def write(rows: DataFrame, batch_id: int) -> None:
        append(audited_rows(csv_rows(rows, schema), run_id), batch_id)

    return (
        arriving_rows(wh, entity, schema)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def promote_available(wh: Warehouse, options: runs.RunOptions | None = None) -> str | None:
    """One run over all file dates that follow the watermark and are complete; a backlog is one batch."""
    if control.get_watermark(wh) is None:
        return None
    return runs.incremental(wh, options, most=None)


def pending_dates(wh: Warehouse) -> list[dt.date]:
    """Bronze file dates that lie after the watermark."""
    mark = control.get_watermark(wh)
    loads = wh.appended("pipeline/loads").where(F.col("entity") == "transactions").select("date").distinct()
    return sorted(row[0] for row in loads.collect() if mark is None or row[0] > mark)
