"""Audit columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

FILE_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"


def new_run_id() -> str:
    """One value per run, made once and passed on as a literal."""
    return str(uuid.uuid4())


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_date(path: Column) -> Column:
    """Date in the file name; null when there is none."""
    return F.nullif(F.regexp_extract(file_name(path), FILE_DATE_PATTERN, 1), F.lit("")).cast("date")


def ingest_columns(source_file: Column, run_id: str) -> dict[str, Column]:
    return {
        "_source_file": source_file,
        "_ingested_at": F.current_timestamp(),
        "_pipeline_run_id": F.lit(run_id),
    }
