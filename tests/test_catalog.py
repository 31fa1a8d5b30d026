"""Every registered query against its SQL on the small test tables, and the shape of its plan."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from strataledger.catalog import registered, sql_text
from tools.compare import TABLES, normal_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registered(), sql_text()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


def test_weeks_end_with_the_data(spark, duck):
    """All purchases of complete weeks are in the weekly summary."""
    total = QUERIES["weekly_customer_lineitems"](spark, SF_DIR).agg({"total_purchases": "sum"}).first()[0]
    classified = SQL["lineitem_classify"]
    kept = duck.execute(
        f"""WITH c AS ({classified}) SELECT COUNT(*) FROM c WHERE _rejection_reason IS NULL AND transaction_code = 'N'
            AND transaction_date < (SELECT CAST(date_trunc('week', MAX(CAST(l_shipdate AS DATE)) + 1) AS DATE) FROM lineitem)
            AND account_id IN (SELECT account_id FROM ({SQL["accounts_latest"]}))"""
    ).fetchall()[0][0]
    assert total == kept


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", plan)
    rows = [tuple(r) for r in df.collect()]
    if name in SQL:
        cursor = duck.execute(SQL[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(df.columns) == sorted(columns)
        assert normal_rows(df.columns, rows) == normal_rows(columns, cursor.fetchall())
        assert not [d for d in cursor.description if str(d[1]).startswith(("HUGEINT", "DECIMAL"))]


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
