"""Registered queries over intervals and digest trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataledger.catalog.registry import query
from strataledger.catalog.sql_layers import LAYERS, with_
from strataledger.operators import digest_tree
from strataledger.operators.intervals import days_in_intervals

# Four cycles per account; the next one starts before the last one ends.
CYCLES = """
cycles AS (
  SELECT account_id, CAST(DATE '2023-12-28' + CAST(account_id AS INTEGER) % 11 + 7 * n AS DATE) AS cycle_start,
         CAST(DATE '2023-12-28' + CAST(account_id AS INTEGER) % 11 + 7 * n + 3 + CAST(account_id AS INTEGER) % 23 AS DATE) AS cycle_end
  FROM accounts, (SELECT unnest([0, 1, 2, 3]) AS n) steps)"""


@query(
    "cycle_activity",
    with_(*LAYERS, CYCLES)
    + """SELECT c.account_id, cycle_start, cycle_end, COUNT(*) AS transactions, CAST(SUM(signed) AS DOUBLE) AS total_signed_amount
         FROM silver s JOIN cycles c ON s.account_id = c.account_id AND s.transaction_date BETWEEN c.cycle_start AND c.cycle_end
         WHERE resolvable GROUP BY c.account_id, cycle_start, cycle_end""",
)
def cycle_activity(layers):
    """Resolvable rows within each billing cycle of their account. Cycles overlap, so a row may count for several."""
    number = F.col("account_id").cast("int")
    steps = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n")
    start = F.date_add(F.lit("2023-12-28").cast("date"), (number % 11 + 7 * F.col("n")).cast("int"))
    cycles = layers.accounts.select("account_id", steps).withColumn("cycle_start", start)
    cycles = cycles.withColumn("cycle_end", F.date_add("cycle_start", (number % 23 + 3).cast("int"))).drop("n")
    facts = layers.silver.where("_is_resolvable").select("account_id", "transaction_date", "_signed_amount")
    inside = days_in_intervals(facts, "transaction_date", cycles, "cycle_start", "cycle_end", on=["account_id"])
    return inside.groupBy("account_id", "cycle_start", "cycle_end").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("_signed_amount").cast("double").alias("total_signed_amount")
    )


KEY = ["transaction_id"]
COLUMNS = ["account_id", "transaction_date", "amount", "transaction_code", "channel", "_signed_amount", "_is_resolvable"]
_FIELDS = ("transaction_id", "account_id", "transaction_date", "amount", "transaction_code", "channel", "signed", "resolvable")
_ROW = " || ".join(
    f"CASE WHEN {f} IS NULL THEN '-' ELSE length(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR) END" for f in _FIELDS
)
DIGESTED = f"""
digested AS (SELECT transaction_id, date, md5({_ROW}) AS digest FROM silver)"""
# The planted change: on two dates some amounts change, some rows go, and some come twice under new ids.
PLANTED = f"""
planted AS (
  SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, account_id, transaction_date,
         CAST(CASE WHEN date IN (DATE '2024-01-05', DATE '2024-01-20') AND CAST(transaction_id AS BIGINT) % 7 = 0
              THEN amount + 1 ELSE amount END AS DECIMAL(18,2)) AS amount,
         transaction_code, channel, signed, resolvable, date
  FROM silver WHERE NOT (date IN (DATE '2024-01-05', DATE '2024-01-20') AND CAST(transaction_id AS BIGINT) % 11 = 0)
  UNION ALL
  SELECT 'n' || transaction_id, account_id, transaction_date, amount, transaction_code, channel, signed, resolvable, date
  FROM silver WHERE date IN (DATE '2024-01-05', DATE '2024-01-20') AND CAST(transaction_id AS BIGINT) % 13 = 0),
digested_planted AS (SELECT transaction_id, date, md5({_ROW}) AS digest FROM planted)"""


@query(
    "digest_by_date",
    with_(*LAYERS, DIGESTED)
    + f"""SELECT date, COUNT(*) AS row_count, CAST(SUM(CAST('0x' || substr(digest, 1, {digest_tree.DIGITS}) AS BIGINT)) AS VARCHAR) AS digest
          FROM digested GROUP BY date""",
)
def digest_by_date(layers):
    """The dates' level of silver's digest tree."""
    level = digest_tree.dates(digest_tree.leaves(digest_tree.digested(layers.silver, KEY, COLUMNS)))
    return level.withColumn("digest", F.col("digest").cast("string"))


@query(
    "digest_changes",
    with_(*LAYERS, DIGESTED, PLANTED)
    + """SELECT coalesce(o.date, n.date) AS date, coalesce(o.transaction_id, n.transaction_id) AS transaction_id,
         CASE WHEN o.digest IS NULL THEN 'added' WHEN n.digest IS NULL THEN 'removed' ELSE 'changed' END AS change
         FROM digested o FULL JOIN digested_planted n ON o.transaction_id = n.transaction_id AND o.date = n.date
         WHERE o.digest IS DISTINCT FROM n.digest""",
)
def digest_changes(layers):
    """Rows that differ between silver and a version with planted changes, found through both digest trees."""
    old = layers.silver_table
    number = F.col("transaction_id").cast("long")
    planted = F.col("date").isin(["2024-01-05", "2024-01-20"])
    amount = F.when(planted & (number % 7 == 0), F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)")
    copies = old.where(planted & (number % 13 == 0)).withColumn("transaction_id", F.concat(F.lit("n"), F.col("transaction_id")))
    new = old.where(~(planted & (number % 11 == 0))).withColumn("amount", amount).unionByName(copies)
    rows = [digest_tree.digested(version, KEY, COLUMNS) for version in (old, new)]
    trees = [layers.staged(digest_tree.leaves(version), "digest_leaves") for version in rows]
    return digest_tree.changed_rows(*rows, KEY, *digest_tree.differing_branches(*trees))
