"""A corpus from documents to packed sequences: each stage applies one operator of ``strataledger.llm``.

All stages but the last return the columns of ``documents``; every stage works on all rows that its predecessor
kept. An empty table stays empty, null texts pass the filters and are packed as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataledger.llm import near_duplicates, packing, personal_data, positional_index, quality_cnn
from strataledger.llm.common import stored, table, tuned

# Near-duplicates of this stage, looser than op6's contract: five-word shingles from 80 % on. A pair at the threshold shares
# one of the bands with probability 0.99998.
NEAR_PERCENT, NEAR_BANDS, NEAR_ROWS = 80, 28, 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the byte-level network rejects."""
    return quality_cnn.accepted(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    tuned(spark)
    return near_duplicates.deduplicated(docs, NEAR_PERCENT, NEAR_BANDS, NEAR_ROWS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark phrase."""
    return positional_index.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text."""
    tuned(spark)
    clean = personal_data.redact(docs, personal_data.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", size)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    tuned(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", pack),
]

# The stages that train models and pack tokens have no SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
