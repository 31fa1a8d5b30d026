"""Bounded training samples for the classifiers of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataledger.llm.common import id_remainder

HELD_OUT_DIVISOR = 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """Columns doc_id, label, text of at most ``rows`` labelled documents outside the held-out fifth.

    The rows with the smallest id hashes are taken. Other labels than 0 and 1 are ignored; where an id
    has both labels, 1 counts; of several texts of one id, the smallest non-null one is taken.
    """
    chosen = (
        labels.where(id_remainder("doc_id", HELD_OUT_DIVISOR) != 0)
        .where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # ``rows`` bounds the broadcast side, so documents are filtered where they are read.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
