"""Audit log of runs: last entry per step, lost runs, and steps skipped after a failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.operators.joins import latest_per_key, without_keys

# The steps of one file date in their order, then the steps of the Gold layer.
DATE_STEPS = (
    ("bronze_accounts", "BRONZE"),
    ("silver_accounts", "SILVER"),
    ("bronze_transactions", "BRONZE"),
    ("silver_transactions", "SILVER"),
)
CODE_STEPS = (("bronze_transaction_codes", "BRONZE"), ("silver_transaction_codes", "SILVER"))
GOLD_STEPS = (("gold_daily_summary", "GOLD"), ("gold_weekly_account_summary", "GOLD"))


# What a later run notes about a run whose log rows are missing; it follows the run id.
UNLOGGED_NOTE = " moved the watermark, so its data is published, but it left no log rows"


def last_entries(log: DataFrame, sequence: str) -> DataFrame:
    """One row per (run, step, date): the entry with the greatest ``sequence``."""
    return latest_per_key(log, ["run_id", "model_name", "target_date"], [sequence])


def lost_runs(control: DataFrame, log: DataFrame) -> DataFrame:
    """Run ids that advanced the watermark but left no log row."""
    ids = control.select(F.col("updated_by_run_id").alias("run_id"))
    return without_keys(ids, log.select("run_id"), "run_id")


def lost_run_rows(lost: DataFrame, current_run_id: str) -> DataFrame:
    """The log row that records a lost run on behalf of the current run."""
    note = F.concat(F.col("run_id"), F.lit(UNLOGGED_NOTE))
    return lost.select(
        F.lit(current_run_id).alias("run_id"),
        F.lit("UNLOGGED_RUN").alias("model_name"),
        F.lit("ORCHESTRATION").alias("layer"),
        F.lit("FAILED").alias("status"),
        note.alias("error_message"),
    )


def checked_control(control: DataFrame) -> DataFrame:
    """The control row, or a failing job when there are several rows or a null run id."""
    state = control.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("updated_by_run_id").alias("with_id"),
        F.max("last_processed_date").alias("last_processed_date"),
        F.max("updated_at").alias("updated_at"),
        F.max("updated_by_run_id").alias("updated_by_run_id"),
    )
    verdict = (
        F.when(F.col("n") > 1, F.raise_error(F.lit("control table has more than one row")))
        .when(F.col("with_id") < F.col("n"), F.raise_error(F.lit("control table has a null run id")))
        .otherwise(F.col("n") == 1)
    )
    return state.where(verdict).drop("n", "with_id")


def _steps_array(steps: tuple = DATE_STEPS) -> Column:
    return F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(model).alias("model_name"), F.lit(layer).alias("layer"))
            for i, (model, layer) in enumerate(steps)
        ]
    )


def skipped_steps(dates: DataFrame, failed_date: str, failed_model: str) -> DataFrame:
    """SKIPPED rows after one failed step: the later steps of its date, all steps of later dates, and
    Gold once. The step list is fixed and the calendar bounds the dates."""
    failed_step = [model for model, _ in DATE_STEPS].index(failed_model)
    day = F.lit(failed_date).cast("date")
    per_date = (
        dates.where(F.col("date") >= day)
        .select("date", F.inline(_steps_array()))
        .where((F.col("date") > day) | (F.col("step") > failed_step))
        .select(F.col("date").cast("string").alias("target_date"), "model_name", "layer")
    )
    gold = (
        dates.sparkSession.range(1)
        .select(F.lit(None).cast("string").alias("target_date"), F.inline(_steps_array(GOLD_STEPS)))
        .drop("step")
    )
    return per_date.unionByName(gold).withColumn("status", F.lit("SKIPPED"))
