"""Source files: listing, typed CSV scans, row positions, and removal of stale outputs."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, DecimalType, StringType, StructField, StructType

from strataledger.functions.audit import file_date, ingest_columns
from strataledger.functions.dates import days_between
from strataledger.operators.checks import absent_dates
from strataledger.schemas import MONEY, POSITION
from strataledger.session import scratch_path


BROKEN = "_broken_row"


def csv_options(reader, schema: StructType, multiline: bool = False):
    """A CSV reader after RFC 4180: header, quoted separators, doubled quotes. All columns are read as text.

    ``multiline`` also accepts line breaks inside quotes; such files are not split, so one task reads each.
    """
    text = StructType([StructField(name, StringType()) for name in schema.fieldNames()] + [StructField(BROKEN, StringType())])
    return (
        reader.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("columnPruning", False)  # a query that needs few columns counts the fields of a row as well
        .option("columnNameOfCorruptRecord", BROKEN)
    )


def typed(column: str, kind: DataType) -> Column:
    """A text column in its type, null if it does not parse. An amount with more decimal places than money
    has is no amount either: rounding it would change the total."""
    value = F.col(column)
    if kind == MONEY:
        exact = value.try_cast(DecimalType(38, 18))
        return F.when(exact == F.round(exact, 2), exact).try_cast(MONEY)
    return value.try_cast(kind)


def scanned(raw: DataFrame) -> DataFrame:
    """A CSV scan with its file name and the first byte of the row's split."""
    return raw.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def csv_rows(scan: DataFrame, schema: StructType) -> DataFrame:
    """Typed rows of ``scanned`` text with their ``_source_position``, ``_file`` and ``_broken_row``; rows must come in the
    scan's order.

    A row with another number of fields than the header, such as the first half of a quoted line break, would shift
    values into other columns, and no later check could tell. Its text is in ``_broken_row``, which is null for all others.
    """
    within_split = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    place = F.col("_block").cast("decimal(15,0)") * F.lit(10**12).cast("decimal(13,0)")
    placed = scan.withColumn("_source_position", (place + within_split.cast("decimal(12,0)")).cast(POSITION))
    # Spark does not read the column of broken rows alone, so its expression also names a source column.
    broken = F.when(F.col(BROKEN).isNotNull() & (F.coalesce(F.length(schema.fieldNames()[0]), F.lit(0)) >= 0), F.col(BROKEN))
    columns = [typed(f.name, f.dataType).alias(f.name) for f in schema.fields]
    return placed.select(*columns, "_source_position", "_file", broken.alias(BROKEN))


def whole_rows(rows: DataFrame) -> DataFrame:
    """``csv_rows`` without broken rows; one of them fails the scan."""
    message = F.concat(F.lit("CSV row with a wrong number of fields: "), F.col(BROKEN))
    fine = F.when(F.col(BROKEN).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return rows.where(fine).drop(BROKEN)


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType, multiline: bool = False) -> DataFrame:
    """Source rows with stated types, and the text of broken ones. A header that names other columns is an error; a
    value that does not parse becomes null and is left to the quality rules."""
    return csv_rows(scanned(csv_options(spark.read, schema, multiline).csv(paths)), schema)


def audited_rows(rows: DataFrame, run_id: str) -> DataFrame:
    """Audit columns and the file ``date``, from column ``_file``."""
    name = F.col("_file")
    return rows.withColumns({**ingest_columns(name, run_id), "date": file_date(name)}).drop("_file")


def bronze_rows(spark: SparkSession, paths: list[str], schema: StructType, run_id: str, multiline: bool = False) -> DataFrame:
    """Source rows, broken ones among them, with their position, audit columns and the file ``date``."""
    return audited_rows(read_csv(spark, paths, schema, multiline), run_id)


def source_dates(spark: SparkSession, source: str, entity: str) -> DataFrame:
    """Dates for which a source file exists. Only the listing is used; no file is opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"{entity}_*.csv").load(source)
    dates = listing.select(file_date(F.col("path")).alias("date"))
    return dates.where(F.col("date").isNotNull()).distinct()


def missing_sources(spark: SparkSession, source: str, start: str, end: str) -> DataFrame:
    """Expected but absent source files of a date range: ``entity, date``."""
    days = days_between(spark, start, end)

    def absent(entity: str) -> DataFrame:
        gaps = absent_dates(days, source_dates(spark, source, entity), "date")
        return gaps.select(F.lit(entity).alias("entity"), "date")

    return absent("accounts").unionByName(absent("transactions"))


def local_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few driver rows as a literal relation: the planner knows its size, and no Python worker runs."""
    names = schema.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def written(
    spark: SparkSession, rows: DataFrame, name: str, partition_by: Iterable[str] = ()
) -> tuple[DataFrame, str]:
    """Write rows to the shared folder and read them back; also returns the folder.

    Later steps start from a table whose size is known and that outlives any executor.
    """
    path = scratch_path(spark, name)
    rows.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
