"""Chat formatting after cumulative-snapshot collapse.

A chat log often holds a conversation again with every new turn. A turn's hash covers its position, role and text; the sum
of the hashes of the first k turns names the prefix of length k. Sums are made per block of BLOCK turns and
then over the blocks of a conversation, so one conversation's turns need not meet in one task. A conversation whose full
sum equals another's prefix sum of the same length, with more turns behind it, is a prefix of that one: an anti-join leaves
it out. Of equal conversations the smallest id stays.

Sums are two independent 64-bit hashes each, kept as exact decimals. What stays is rendered: every turn as a header with its role and
its text, in blocks of BLOCK turns, so an ordinary conversation is one row and an endless one many bounded rows.

Turns are ordered by number; a null number comes first, ties are ordered by role and text, and turns that repeat
number, role and text count once. Null roles and texts are empty. Turns without a conversation id are left out, as nothing
says what they belong to. An empty table gives no rows. Other columns than these four are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataledger.llm.common import stored

BLOCK = 256
SUM = "decimal(38,0)"


def turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "place", "role", "text").cast(SUM)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """Turns with their place from 0 in the conversation; numbering goes by blocks of turn numbers."""
    turns = conversations.where("conv_id is not null").select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    turns = turns.withColumn("range", F.floor(F.coalesce("turn", F.lit(-(1 << 62))) / BLOCK))
    sizes = turns.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "range").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = turns.withColumn("within", F.row_number().over(inside) - 1).join(before, ["conv_id", "range"])
    place = F.col("before") + F.col("within")
    return numbered.select("conv_id", place.alias("place"), F.floor(place / BLOCK).alias("block"), "role", "text")


def prefix_sums(turns: DataFrame) -> DataFrame:
    """Columns conv_id, turns (how many) and two sums, for every prefix of every conversation."""
    hashed = turns.select("conv_id", "place", "block", turn_hash(1).alias("one"), turn_hash(2).alias("two"))
    inside = Window.partitionBy("conv_id", "block").orderBy("place")
    running = hashed.select(
        "conv_id", "block", "place", F.sum("one").over(inside).cast(SUM).alias("one"), F.sum("two").over(inside).cast(SUM).alias("two")
    )
    totals = hashed.groupBy("conv_id", "block").agg(F.sum("one").cast(SUM).alias("one"), F.sum("two").cast(SUM).alias("two"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(SUM)
    before = totals.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("one").over(earlier).cast(SUM), zero).alias("one_before"),
        F.coalesce(F.sum("two").over(earlier).cast(SUM), zero).alias("two_before"),
    )
    return running.join(before, ["conv_id", "block"]).select(
        "conv_id",
        (F.col("place") + 1).alias("turns"),
        (F.col("one") + F.col("one_before")).cast(SUM).alias("one"),
        (F.col("two") + F.col("two_before")).cast(SUM).alias("two"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """Columns conv_id and turns of the conversations that no other one continues or, with a smaller id, repeats."""
    sums = stored(prefix_sums(turns), "prefixes")
    last = sums.groupBy("conv_id").agg(F.max("turns").alias("turns"))
    whole = sums.join(last, ["conv_id", "turns"])
    # One conversation for each different content, before anything is compared.
    unique = whole.groupBy("turns", "one", "two").agg(F.min("conv_id").alias("conv_id"))
    kept = unique.select("conv_id", "turns")
    # Proper prefixes; each different one once, however many conversations begin with it.
    inner = sums.join(kept.withColumnRenamed("turns", "size"), "conv_id").where("turns < size")
    return unique.join(inner.select("turns", "one", "two").distinct(), ["turns", "one", "two"], "left_anti").select("conv_id", "turns")


def render(conversations: DataFrame) -> DataFrame:
    """Columns conv_id, turns, block and text: the maximal conversations, BLOCK turns to a row."""
    turns = stored(placed_turns(conversations), "turns")
    said = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n"))
    kept = turns.join(maximal(turns), "conv_id").select("conv_id", "turns", "block", "place", said.alias("said"))
    # At most BLOCK turns in a group.
    grouped = kept.groupBy("conv_id", "turns", "block").agg(F.sort_array(F.collect_list(F.struct("place", "said"))).alias("parts"))
    return grouped.select("conv_id", "turns", "block", F.array_join(F.transform("parts", lambda p: p["said"]), "").alias("text"))
