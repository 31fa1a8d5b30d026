"""Interval join: rows with a day that lies in the closed intervals of another table.

An inequality join compares every row with every interval. Here intervals are cut into bins and joined by equality, and
the exact test follows. A bin is as wide as the smallest power of two that is no shorter than the interval, so an interval of any
length falls into two bins at most; rows look into one bin of each width that occurs. There are no more
widths than the calendar has binary digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bin(day: Column, level: Column) -> Column:
    """Number of the bin of width 2 ** level; days before 1970 have negative ones."""
    return F.floor(F.unix_date(day) / F.pow(F.lit(2.0), level)).cast("long")


def days_in_intervals(rows: DataFrame, day: str, intervals: DataFrame, start: str, end: str, on: Sequence[str] = ()) -> DataFrame:
    """Inner join on ``on`` and ``start <= day <= end``; a row comes once for each interval that holds it.

    A null day, bound or key matches nothing, nor does an interval that ends before it starts. Columns other
    than the keys must differ by name.
    """
    length = F.datediff(end, start) + 1
    level = F.ceil(F.log2(length.cast("double"))).cast("int")
    cut = intervals.where(F.col(start) <= F.col(end)).withColumn("_level", level)
    # One row per width that occurs; the driver needs them to say where rows look.
    levels = [row[0] for row in cut.select("_level").distinct().collect()]
    if not levels:
        levels = [0]
    first, last = _bin(F.col(start), F.col("_level")), _bin(F.col(end), F.col("_level"))
    binned = cut.withColumn("_bin", F.explode(F.sequence(first, last)))
    places = F.array(*[F.struct(F.lit(n).alias("_level"), _bin(F.col(day), F.lit(n)).alias("_bin")) for n in sorted(levels)])
    looking = rows.where(F.col(day).isNotNull()).select("*", F.inline(places))
    joined = looking.join(binned, [*on, "_level", "_bin"])
    return joined.where(F.col(day).between(F.col(start), F.col(end))).drop("_level", "_bin")
