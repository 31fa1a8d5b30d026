"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataledger.session import configure, scratch_path

# Rows and bytes that Spark hands to a Python worker at once: a bound on the worker's memory.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def tuned(spark: SparkSession) -> SparkSession:
    """The library's runtime settings and small Arrow batches."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the shared folder, for results that are read more than once.

    It survives lost executors, and its lineage ends there.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def blocks(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that column ``text`` has about ``size`` bytes in each, one whole row at least."""
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


# Tables up to this size are sent to all tasks; larger ones are joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def small_side(rows: DataFrame) -> DataFrame:
    """``rows``, best a stored table, with a broadcast hint if their measured bytes are few."""
    width = sum((F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in rows.columns), F.lit(16))
    held = rows.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(rows) if held <= BROADCAST_BYTES else rows


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        column.cast(field.type) if isinstance(column, pa.Array) else pa.array(column, type=field.type)
        for field, column in zip(schema, columns)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
