"""Plans at scale: splitting of hot keys, pruning, and what is broadcast."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from strataledger import schemas
from strataledger.catalog import QUERIES
from strataledger.operators import daily as dly
from strataledger.operators import joins
from strataledger.operators import transactions as txn
from strataledger.operators import weekly as wk
from strataledger.session import configure
from strataledger.sources.files import local_frame

from test_rules import codes


@contextmanager
def settings(spark, **conf):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# A large unique side and small partitions stand in for a large data set.
LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
}


def hot_bronze(spark, n=60_000):
    """A third of the rows have one account, a third have no account."""
    account = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("A"), F.col("id") % 500))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    return spark.range(n).select(
        F.concat(F.lit("T"), F.col("id")).alias("transaction_id"),
        account.alias("account_id"),
        day.alias("transaction_date"),
        F.lit(5).cast(schemas.MONEY).alias("amount"),
        F.lit("P").alias("transaction_code"),
        F.lit("M").alias("merchant_name"),
        F.lit("ONLINE").alias("channel"),
        F.lit("f").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        F.lit("r").alias("_pipeline_run_id"),
        day.alias("date"),
    )


def first_seen(spark):
    names = spark.range(500).select(F.concat(F.lit("A"), F.col("id")).alias("account_id"))
    return names.unionByName(spark.sql("SELECT 'HOT' AS account_id")).withColumn(
        "_first_seen_date", F.lit("2024-01-01").cast("date")
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    executed = df.collect() and df._jdf.queryExecution().executedPlan().toString()
    return executed


def test_hot_account_is_split_and_null_accounts_are_spread(spark):
    bronze = hot_bronze(spark)
    rows = bronze.withColumn("_rejection_reason", F.when(F.col("account_id").isNull(), "NULL_REQUIRED_FIELD")).withColumn(
        "_ok", F.col("account_id").isNotNull()
    )
    with settings(spark, **LARGE):
        joined = txn.resolve(rows, first_seen(spark))
        plan = final_plan(joined)
        assert "skew=true" in plan
        counts = joined.groupBy("_is_resolvable").count().collect()
        # Rejected rows cannot match and lie in many partitions, though their account is null.
        spread = joins.left_join_eligible(
            rows, first_seen(spark), "account_id", F.col("_ok"), txn.SPREAD_BY
        ).where("NOT _ok").groupBy(F.spark_partition_id()).count()
        assert spread.count() > 10
    assert {r._is_resolvable: r["count"] for r in counts} == {True: 40_000, None: 20_000}


def test_accepted_rows_are_filtered_below_the_joins(spark):
    with settings(spark, **LARGE):
        resolved = txn.resolve(txn.classify(hot_bronze(spark), codes(spark)), first_seen(spark))
        plan = txn.accepted(resolved, "r")._jdf.queryExecution().optimizedPlan().toString()
    # Top down: account join, id join, then on the bronze side a filter above the code join.
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    joins_at = [i for i, line in enumerate(lines) if line.startswith("Join LeftOuter")]
    assert ["account_id" in lines[joins_at[0]], "transaction_id" in lines[joins_at[1]]] == [True, True]
    assert any(line.startswith("Filter") for line in lines[joins_at[1] : joins_at[2]])


@pytest.fixture(scope="module")
def silver_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "t")
    resolved = txn.resolve(txn.classify(hot_bronze(spark, 3000), codes(spark)), first_seen(spark))
    txn.accepted(resolved, "r").write.partitionBy("date").parquet(path)
    return path


def test_gold_reads_only_its_columns_and_partitions(spark, silver_path):
    silver = spark.read.schema(schemas.SILVER_TRANSACTIONS).parquet(silver_path)
    with settings(spark, spark__sql__maxMetadataStringLength="2000"):
        plan = dly.daily_partials(silver.where("date = '2024-01-02'"), codes(spark))._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*date#\d+ = 2024-01-02", plan)
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", read)) == {
        "transaction_date", "transaction_code", "channel", "_is_resolvable", "_signed_amount",
    }


def test_weeks_are_an_equi_join_with_partial_aggregation(spark, silver_path):
    silver = spark.read.schema(schemas.SILVER_TRANSACTIONS).parquet(silver_path)
    weeks = wk.uncomputed_weeks(silver.where("_is_resolvable"), local_frame(spark, [], schemas.WEEK_REGISTRY), "2024-01-31")
    df = wk.weekly_measures_of(silver, codes(spark), weeks)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "BroadcastHashJoin" in plan
    assert "partial_count" in plan
    got = {(r.account_id, r.total_purchases) for r in df.collect()}
    assert ("HOT", 1000) in got


def test_staged_ids_decide_their_join_by_size(spark, tmp_path):
    """Written blocked ids have a measured size: small ones are broadcast and bronze is not shuffled."""
    def stage(rows, name):
        rows.write.parquet(str(tmp_path / name))
        return spark.read.schema(rows.schema).parquet(str(tmp_path / name))

    df = txn.classify(hot_bronze(spark, 3000), codes(spark), stage=stage)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_batch_ids_prune_the_history_scan(spark, silver_path, tmp_path):
    """The scan of all accepted ids is filtered by a bloom filter over the ids of the batch."""
    plans = []

    def stage(rows, name):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        rows.write.parquet(str(tmp_path / name))
        return spark.read.schema(rows.schema).parquet(str(tmp_path / name))

    history = spark.read.schema(schemas.SILVER_TRANSACTIONS).parquet(silver_path).select("transaction_id")
    always = {"spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "0"}
    with settings(spark, **LARGE, **always):
        got = txn.classify(hot_bronze(spark, 6000), codes(spark), history, stage=stage)
        counts = {r._rejection_reason: r["count"] for r in got.groupBy("_rejection_reason").count().collect()}
    assert "might_contain" in plans[-1]
    # Of 6,000 rows a third has no account; the ids of the first 3,000 are in the history.
    assert counts == {"NULL_REQUIRED_FIELD": 2000, "DUPLICATE_TRANSACTION_ID": 2000, None: 2000}


@pytest.mark.parametrize("name", ["accounts_latest", "accounts_upsert"])
def test_latest_accounts_sort_no_rows(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_planner_broadcasts_are_bounded(spark, tmp_path):
    """A stored side whose files are below Spark's own limit of 10 MB, but not below the library's, is not sent to all tasks."""
    path = str(tmp_path / "accounts")
    spark.range(200_000).selectExpr("uuid() as account_id").coalesce(1).write.parquet(path)
    side = spark.read.schema("account_id string").parquet(path)
    rows = spark.range(1_000).selectExpr("cast(id as string) as account_id")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10m"):
        configure(spark)
        assert "Broadcast" not in final_plan(rows.join(side, "account_id", "left"))
        side.limit(10).write.parquet(f"{path}_few")
        few = spark.read.schema("account_id string").parquet(f"{path}_few")
        assert "Broadcast" in final_plan(rows.join(few, "account_id", "left"))
    for less in ("-1", "1000", "2k"):
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=less):
            configure(spark)
            assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == less
