"""Gold daily summary: one row per calendar day, days without rows included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataledger.functions.measures import DAILY_MONEY, added_measures, daily_measures, type_columns
from strataledger.schemas import GOLD_DAILY, TRANSACTION_TYPES


def with_type(silver: DataFrame, codes: DataFrame) -> DataFrame:
    """Silver rows with their transaction type; rows without a known code keep a null type."""
    return silver.join(codes.select("transaction_code", "transaction_type"), "transaction_code", "left")


def daily_partials(silver: DataFrame, codes: DataFrame, by: tuple[str, ...] = ("transaction_date",)) -> DataFrame:
    """Additive measures per day. With ``by=("date", "transaction_date")`` the rows of one file date
    can be stored and added to those of other file dates later, so an increment reads only its own
    silver partition."""
    return with_type(silver, codes).groupBy(*by).agg(*daily_measures())


def added_days(partials: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """Add up partial rows per day. ``processed`` (column ``date``) adds a zero row for each file date,
    so a day whose rows were all rejected has a row too."""
    if processed is not None:
        dates = processed.select(F.col("date").alias("transaction_date")).distinct()
        partials = partials.unionByName(dates, allowMissingColumns=True)
    return partials.groupBy("transaction_date").agg(*added_measures())


def dense_days(days: DataFrame) -> DataFrame:
    """Put a zero row on every missing day between the first and the last one. One row per day comes in.

    The gaps come from a look at the next day present, not from a second scan for the bounds. The
    ordered pass sees one row per calendar day, never transactions.
    """
    by_day = Window.orderBy("transaction_date")
    everything = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    has_rows = F.when(F.col("silver_rows") > 0, F.col("transaction_date"))
    until = F.coalesce(F.date_sub(F.lead("transaction_date").over(by_day), 1), F.col("transaction_date"))
    bounds = {
        "_source_period_start": F.min(has_rows).over(everything),
        "_source_period_end": F.max(has_rows).over(everything),
        "_until": until,
    }
    filled = (
        days.where(F.col("transaction_date").isNotNull())
        .withColumns(bounds)
        .withColumn("_day", F.explode(F.sequence("transaction_date", "_until")))
    )
    present = F.col("_day") == F.col("transaction_date")
    measures = [f for f in days.schema.fields if f.name != "transaction_date"]
    filled_in = [F.when(present, F.col(f.name)).otherwise(F.lit(0).cast(f.dataType)).alias(f.name) for f in measures]
    return filled.select(
        F.col("_day").alias("transaction_date"), *filled_in, "_source_period_start", "_source_period_end"
    )


def flat_daily(dense: DataFrame) -> DataFrame:
    """Money as doubles; the per-type measures stay flat columns."""
    money = {name: F.col(name).cast("double") for name in DAILY_MONEY}
    return dense.withColumns(money).drop("silver_rows")


def nested_by_type() -> Column:
    """``transactions_by_type``: one struct of count and sum per transaction type."""
    parts = []
    for kind in TRANSACTION_TYPES:
        count_name, sum_name = type_columns(kind)
        parts.append(F.struct(F.col(count_name).alias("count"), F.col(sum_name).alias("sum_signed_amount")).alias(kind))
    return F.struct(*parts).alias("transactions_by_type")


def gold_daily(dense: DataFrame, run_id: str) -> DataFrame:
    """The published table, with nested type measures and audit columns."""
    return (
        flat_daily(dense)
        .withColumn("transactions_by_type", nested_by_type())
        .withColumn("_computed_at", F.current_timestamp())
        .withColumn("_pipeline_run_id", F.lit(run_id))
        .select(*GOLD_DAILY.fieldNames())
    )


def daily_summary(silver: DataFrame, codes: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """Flat daily summary straight from silver rows."""
    days = daily_partials(silver, codes)
    return flat_daily(dense_days(days if processed is None else added_days(days, processed)))
