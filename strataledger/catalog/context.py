"""The layers as lazy DataFrames over one directory of test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataledger.operators import accounts as acc
from strataledger.operators import transactions as txn
from strataledger.operators import weekly as wk
from strataledger.schemas import WEEKS
from strataledger.session import configure
from strataledger.sources import feeds
from strataledger.sources.files import local_frame, written


class Layers:
    """Every attribute is a plan over whole tables. What is used repeatedly is staged as a table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return feeds.table(self.spark, self.sf_dir, name)

    @staticmethod
    def up_to(rows: DataFrame, day: str) -> DataFrame:
        return rows.where(F.col("date") <= F.lit(day).cast("date"))

    # Bronze

    @cached_property
    def bronze(self) -> DataFrame:
        return feeds.event_transactions(self.spark, self.sf_dir)

    @cached_property
    def batch_end(self) -> str:
        """The last file date of the feed."""
        return str(self.bronze.agg(F.max("date")).first()[0])

    @cached_property
    def bronze_accounts(self) -> DataFrame:
        return feeds.customer_accounts(self.spark, self.sf_dir)

    @cached_property
    def codes(self) -> DataFrame:
        return feeds.event_codes(self.spark)

    # Silver

    @cached_property
    def classified_accounts(self) -> DataFrame:
        return acc.classify_accounts(self.bronze_accounts)

    @cached_property
    def passing_accounts(self) -> DataFrame:
        return acc.passing(self.classified_accounts)

    @cached_property
    def accounts(self) -> DataFrame:
        return acc.latest_accounts(self.passing_accounts)

    @cached_property
    def first_run_accounts(self) -> DataFrame:
        return acc.latest_accounts(self.up_to(self.passing_accounts, feeds.FIRST_RUN_END))

    @cached_property
    def first_seen(self) -> DataFrame:
        return acc.first_seen(self.passing_accounts)

    def staged(self, rows: DataFrame, name: str) -> DataFrame:
        """Written once to the shared folder and read back, for results that a query uses repeatedly
        or whose size decides a join."""
        return written(self.spark, rows, name)[0]

    @cached_property
    def classified(self) -> DataFrame:
        return txn.classify(self.bronze, self.codes, stage=self.staged)

    @cached_property
    def silver(self) -> DataFrame:
        return txn.accepted(txn.resolve(self.classified, self.first_seen), F.col("_pipeline_run_id"))

    @cached_property
    def settled(self) -> DataFrame:
        """Both outputs of one classification: silver rows are the accepted ones, the others are quarantined."""
        return txn.settled(txn.resolve(self.classified, self.first_seen), F.col("_pipeline_run_id"))

    @cached_property
    def settled_table(self) -> DataFrame:
        """The same, stored without the columns that no query reads."""
        return self.staged(self.settled.drop("_source_file", "_bronze_ingested_at", "_promoted_at", "_rejected_at"), "settled")

    @cached_property
    def silver_table(self) -> DataFrame:
        """Silver as a stored table, for queries that read it more than once; without the columns
        that none of them reads."""
        unread = ("_source_file", "_bronze_ingested_at", "_promoted_at", "merchant_name")
        return self.staged(self.silver.drop(*unread), "silver")

    @cached_property
    def quarantine(self) -> DataFrame:
        return txn.rejected(self.classified, F.col("_pipeline_run_id"))

    @cached_property
    def first_run_silver(self) -> DataFrame:
        """Silver as the first run left it. Later files never change the outcome of earlier ones."""
        return self.up_to(self.silver_table, feeds.FIRST_RUN_END)

    # Gold

    @cached_property
    def no_weeks(self) -> DataFrame:
        return local_frame(self.spark, [], WEEKS)

    def listed(self, weeks: DataFrame) -> DataFrame:
        """Weeks as a literal list, as a run passes them on; the calendar bounds their number."""
        return local_frame(self.spark, [tuple(r) for r in weeks.select(*WEEKS.fieldNames()).collect()], WEEKS)

    def open_weeks(self, silver: DataFrame, registry: DataFrame, through: str) -> DataFrame:
        return self.listed(wk.uncomputed_weeks(silver.where("_is_resolvable"), registry, through))

    @cached_property
    def first_weeks(self) -> DataFrame:
        return self.open_weeks(self.first_run_silver, self.no_weeks, feeds.FIRST_RUN_END)

    @cached_property
    def first_weekly(self) -> DataFrame:
        return wk.weekly_summary(self.first_run_silver, self.codes, self.first_run_accounts, self.first_weeks)

    @cached_property
    def second_weeks(self) -> DataFrame:
        return self.open_weeks(self.silver_table, self.first_weeks, self.batch_end)

    @cached_property
    def second_weekly(self) -> DataFrame:
        return wk.weekly_summary(self.silver_table, self.codes, self.accounts, self.second_weeks)

    @cached_property
    def weekly(self) -> DataFrame:
        """Weekly table after the second run: new weeks added, registered weeks untouched."""
        return wk.merge_weeks(self.first_weekly, self.second_weekly, self.second_weeks)

    @cached_property
    def all_weeks(self) -> DataFrame:
        return self.open_weeks(self.silver_table, self.no_weeks, self.batch_end)

    @cached_property
    def all_weekly(self) -> DataFrame:
        """All complete weeks computed in one run."""
        return wk.weekly_summary(self.silver_table, self.codes, self.accounts, self.all_weeks)
