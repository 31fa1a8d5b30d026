"""Digest trees: which rows of a large table differ from an earlier version, without comparing all rows.

A row's digest covers its fields; the digests of a bucket of keys within a date are added up, those of the buckets give
the date's, and those of the dates the table's. Two versions are compared from the top: only differing
dates are opened, then only differing buckets, and only their rows are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
# Hexadecimal digits of a digest that are added up, so that a sum of 10^20 rows fits a decimal of 38 digits.
DIGITS = 15


def field_text(name: str) -> Column:
    """A field with its length, so that neighbouring fields cannot be confused; null is a dash."""
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(names: Sequence[str]) -> Column:
    return F.md5(F.concat(*[field_text(name) for name in names]))


def digested(rows: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """date, the key columns, bucket and digest of every row."""
    bucket = F.conv(F.substring(digest_of(key), 1, 8), 16, 10).cast("long") % buckets
    return rows.select("date", *key, bucket.alias("bucket"), digest_of([*key, *columns]).alias("digest"))


def added(digest: Column) -> Column:
    """Sum of digests as an exact number; it does not depend on the order of rows."""
    return F.sum(F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("decimal(38,0)"))


def leaves(rows: DataFrame) -> DataFrame:
    """The lowest level of a tree: rows and digest per (date, bucket) of ``digested`` rows. Small; store it."""
    return rows.groupBy("date", "bucket").agg(F.count(F.lit(1)).alias("row_count"), added(F.col("digest")).alias("digest"))


def dates(level: DataFrame) -> DataFrame:
    """The level above: rows and digest per date."""
    return level.groupBy("date").agg(F.sum("row_count").alias("row_count"), F.sum("digest").alias("digest"))


def differing(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Branches whose rows or digests differ, or that one version lacks."""

    def signed(level: DataFrame, sign: int) -> DataFrame:
        return level.select(*by, (F.col("row_count") * sign).alias("row_count"), (F.col("digest") * F.lit(sign)).cast("decimal(38,0)").alias("digest"))

    sums = signed(old, -1).unionByName(signed(new, 1)).groupBy(*by).agg(F.sum("row_count").alias("rows"), F.sum("digest").alias("digest"))
    return sums.where((F.col("rows") != 0) | (F.col("digest") != 0)).select(*by)


def differing_branches(old: DataFrame, new: DataFrame) -> tuple[list, DataFrame]:
    """Differing dates, and the differing (date, bucket) below them, of two stored ``leaves`` tables."""
    open_dates = [row[0] for row in differing(dates(old), dates(new), ["date"]).collect()]  # the calendar bounds them
    below = [level.where(F.col("date").isin(open_dates)) for level in (old, new)]
    return open_dates, differing(*below, ["date", "bucket"])


def changed_rows(old: DataFrame, new: DataFrame, key: Sequence[str], open_dates: list, branches: DataFrame) -> DataFrame:
    """date, key and change (added, removed or changed) of the rows that differ.

    ``old`` and ``new`` are ``digested`` rows; only those of differing branches are read. Of keys that repeat within
    a date every row counts. Null keys are keys like any other.
    """

    def below(rows: DataFrame, sign: int) -> DataFrame:
        inside = rows.where(F.col("date").isin(open_dates)).join(F.broadcast(branches), ["date", "bucket"], "left_semi")
        return inside.select("date", *key, "digest", F.lit(sign).alias("side"))

    net = below(old, -1).unionByName(below(new, 1)).groupBy("date", *key, "digest").agg(F.sum("side").alias("net"))
    sides = net.where("net != 0").groupBy("date", *key).agg(F.max("net").alias("most"), F.min("net").alias("least"))
    change = F.when(F.col("least") > 0, "added").when(F.col("most") < 0, "removed").otherwise("changed")
    return sides.select("date", *key, change.alias("change"))
