"""Quality rules: text statistics, and a hashed n-gram likelihood ratio of trusted text against the raw corpus.

All rows give the raw counts of hashed word unigrams and bigrams, trusted rows give the target counts. A text's ratio is
the sum over its n-grams of log(target share / raw share), divided by their number. Texts below the
threshold are not kept; there is no sampling. The statistics are one expression over the text; the counts are one pass with
at most two groups per bucket, and the ratio is a look-up in an array of BUCKETS numbers.

Defined results: null, empty and white-space texts have no words; they fail the rules. A text with one
word has one n-gram. Without any trusted row every ratio is 0, and the rules alone decide. Repeated rows are judged
repeatedly. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.llm.common import small_side

BUCKETS = 1 << 13
SMOOTHING = 1.0
THRESHOLD = -0.07
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# White space between words, and characters that count as symbols.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur at least twice in the text."""
    hashes = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), 1, F.size(words) - 2
    )

    def covered(places: Column) -> Column:
        # Sorted starts: each window adds what the next one does not cover.
        added = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(added, F.lit(0), lambda a, b: a + b)

    def starts(ordered: Column) -> Column:
        def same(i: Column) -> Column:
            return F.get(ordered, i)["hash"]

        twice = F.transform(
            ordered,
            lambda p, i: F.when((p["hash"] == same(i + 1)) | ((i > 0) & (p["hash"] == same(F.greatest(i - 1, F.lit(0))))), p["at"]),
        )
        return F.sort_array(F.filter(twice, lambda at: at.isNotNull()))

    def count(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
        several = F.size(F.array_distinct(found)) < F.size(found)
        return F.when(several, bound(bound(ordered, starts), covered)).otherwise(0)

    return F.when(F.size(words) < 4, 0).otherwise(bound(hashes, count)).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    return F.coalesce(bound(lines, lambda some: F.size(some) - F.size(F.array_distinct(some))), F.lit(0)).cast("long")


def statistics(text: Column, words: Column) -> list[Column]:
    return [
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit(SYMBOL)), F.lit(0)).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
    ]


def bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def buckets_of(words: Column) -> Column:
    """Buckets of all words, then of all pairs of neighbours."""
    singles = F.transform(words, lambda w: bucket(w))
    pairs = F.transform(words, lambda w, i: bucket(w, F.get(words, i + 1)))
    return F.concat(singles, F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """log(target share / raw share) of every bucket; ``trusted`` holds column doc_id."""
    ids = trusted.select("doc_id", F.lit(1).alias("target")).where("doc_id is not null").distinct()
    marked = docs.select("doc_id", "text").join(small_side(ids), "doc_id", "left")
    grams = marked.select("target", F.explode(bound(words_of(F.col("text")), buckets_of)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("target").alias("target"))
    rows = counts.collect()  # at most BUCKETS rows
    raw, target = [SMOOTHING] * BUCKETS, [SMOOTHING] * BUCKETS
    for row in rows:
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    if not any(row["target"] for row in rows):
        return [0.0] * BUCKETS
    sum_raw, sum_target = sum(raw), sum(target)
    return [math.log(t / sum_target) - math.log(r / sum_raw) for t, r in zip(target, raw)]


def judged(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row with its statistics, ratio, base_failed and kept."""
    text = F.col("text")
    table = F.split(F.lit(",".join(map(repr, ratios(docs, trusted)))), ",").cast("array<double>")

    def measure(words: Column) -> Column:
        total = F.aggregate(buckets_of(words), F.lit(0.0), lambda sum_, b: sum_ + F.get(table, b))
        ratio = total / F.greatest(2 * F.size(words) - 1, F.lit(1))
        return F.struct(*statistics(text, words), ratio.alias("ratio"))

    measured = docs.select("doc_id", bound(words_of(text), measure).alias("found")).select("doc_id", "found.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= threshold))
