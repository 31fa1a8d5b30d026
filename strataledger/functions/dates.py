"""Calendar helpers. Weeks are ISO weeks: Monday to Sunday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def week_end(day: Column) -> Column:
    return F.date_add(week_start(day), 6)


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def days_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end inclusive, one row each."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date")
    )


def weeks_of(dates: DataFrame, column: str) -> DataFrame:
    """Distinct weeks touched by a date column. The calendar bounds the number of rows."""
    day = F.col(column)
    return (
        dates.select(week_start(day).alias("week_start_date"))
        .where(F.col("week_start_date").isNotNull())
        .distinct()
        .withColumn("week_end_date", F.date_add("week_start_date", 6))
    )
