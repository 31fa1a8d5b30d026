"""Queries by name, with the SQL that states the same result."""

from strataledger.catalog import branches, control, gold, silver, tables, whole_runs  # noqa: F401  (importing registers the queries)
from strataledger.catalog.registry import QUERIES, SQL


def registered() -> dict:
    return dict(QUERIES)


def sql_text() -> dict[str, str]:
    return dict(SQL)
