"""Join shapes shared by the layers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Many more values than shuffle partitions, so the spread stays even at any cluster size.
SPREAD = 1 << 20


def left_join_eligible(
    rows: DataFrame, unique: DataFrame, key: str, eligible: Column, spread_by: tuple[str, ...]
) -> DataFrame:
    """Left join in which only eligible rows may match; ``unique`` has one row per key.

    Rows that cannot match (null ids, rows already rejected) would otherwise meet in the shuffle
    partition of their null or junk key. A second join column spreads them over all partitions by
    ``spread_by``, columns that the caller needs anyway: it is 0 for eligible rows and on the unique
    side, and 1..SPREAD for all others. A hot eligible key is split by AQE, since only the left side
    repeats. When the unique side is small, the planner broadcasts it by its measured size and the
    rows are not shuffled for it.
    """
    by_content = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")
    shard = F.when(eligible, F.lit(0)).otherwise(F.lit(1) + by_content)
    # Computed from the key so that the optimizer keeps it as a join column.
    zero = F.pmod(F.length(key), F.lit(1))
    return (
        rows.withColumn("_shard", shard).join(unique.withColumn("_shard", zero), [key, "_shard"], "left").drop("_shard")
    )


def without_keys(rows: DataFrame, keys: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return rows.join(keys, on, "left_anti")


def replace_by_key(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace existing rows of the same key; other existing rows stay."""
    kept = without_keys(existing, incoming.select(key), key)
    return incoming.unionByName(kept, allowMissingColumns=True)


def place_in_time(date: Column, position: Column) -> Column:
    """File date and place in the file (below 10^27) as one number, so that a hash aggregate can hold the greatest."""
    days = F.coalesce(F.unix_date(date), F.lit(-(10**6))).cast("decimal(7,0)")
    return (days * F.lit(Decimal(10**27)) + F.coalesce(position, F.lit(0)).cast("decimal(27,0)")).cast("decimal(36,0)")


def rows_at_greatest(rows: DataFrame, key: str, place: Column, *more: Column) -> DataFrame:
    """The row of each key with the greatest ``place``, with the aggregates ``more`` of the whole key beside it.

    Only key and place are aggregated, by hash and combined per task; no whole row is sorted. The rows are fetched by key
    and place, so a hot key's rows are spread by their places, and stay where they are when the best places can be
    broadcast. Equal rows of one place become one; different rows need different places. Null keys are left out.
    """
    placed = rows.withColumn("_place", place)
    best = placed.groupBy(F.col(key).alias("_key")).agg(F.max("_place").alias("_best"), *more)
    found = placed.join(best, (F.col(key) == F.col("_key")) & (F.col("_place") == F.col("_best")))
    return found.drop("_key", "_best").distinct().drop("_place")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties settled by the remaining columns.

    An aggregate rather than a ranking window: each task keeps one row per key before the shuffle,
    so a key with very many rows never gathers in one task.
    """
    rest = [name for name in rows.columns if name not in keys and name not in order]
    greatest = F.max(F.struct(*order, *rest)).alias("_row")
    return rows.groupBy(*keys).agg(greatest).select(*keys, "_row.*").select(*rows.columns)
