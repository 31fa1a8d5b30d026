"""Ids that silver accepted, bucketed by their hash.

A batch looks its ids up in the accepted ids of all other dates. Here they lie in buckets of their hash, so that join
needs no exchange of the history: only the batch's ids are dealt to the buckets, or sent to all
tasks where they are few. Every batch adds one file per bucket; batches of one size class are merged from time to time, so
an id is rewritten once per class and the number of files grows with the logarithm of the batches.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Batches of one class that are merged into one of the next class.
MERGED = 16


class IdLedger:
    """Columns transaction_id and date; ``batch`` is a partition, ids are bucketed."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        # The catalog only says how the folder is laid out; it can be made again from the folder's name.
        self.table = f"accepted_ids_{zlib.crc32(f'{path} {buckets}'.encode()):08x}"

    def _register(self, batches: set[str]) -> None:
        self.spark.sql(
            f"""CREATE TABLE IF NOT EXISTS {self.table} (transaction_id STRING, date DATE, batch STRING) USING parquet
            PARTITIONED BY (batch) CLUSTERED BY (transaction_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"""
        )
        known = {row[0].removeprefix("batch=") for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()}
        for batch in sorted(batches - known):
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION (batch = '{batch}')")

    def add(self, ids: DataFrame, batch: str) -> None:
        """Write the ids of a new batch; they count from the commit on that names the batch."""
        self._register(set())
        dealt = ids.select("transaction_id", "date").repartition(self.buckets, "transaction_id")
        dealt.withColumn("batch", F.lit(batch)).write.mode("append").insertInto(self.table)

    def ids(self, dates_of: dict[str, list]) -> DataFrame:
        """Ids of the given dates of each batch; None stands for all dates that the batch was written with."""
        self._register(set(dates_of))
        batch = F.col("batch")
        whole = [name for name, dates in dates_of.items() if dates is None]
        wanted = batch.isin(whole)
        for name, dates in dates_of.items():
            if dates is not None:
                wanted |= (batch == name) & F.col("date").isin(dates)
        # The first condition names partitions only, so others are not listed.
        return self.spark.table(self.table).where(batch.isin(list(dates_of))).where(wanted).select("transaction_id", "date")
