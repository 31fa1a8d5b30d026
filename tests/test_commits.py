"""Commits: what a run that ends anywhere leaves, runs side by side, bounded files, the ledger of accepted ids."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
import sample
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from strataledger.operators import transactions as txn
from strataledger.plans import control, runs, steps, verify
from strataledger.sources import warehouse
from strataledger.sources.commits import Commits, ConcurrentRun, State
from strataledger.sources.files import bronze_rows
from strataledger.sources.ledger import IdLedger
from strataledger.sources.warehouse import Change, Warehouse
from strataledger.streaming.file_stream import append_new_dates


@pytest.fixture
def wh(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    return Warehouse(spark, str(tmp_path / "root"), str(source))


def again(wh):
    """What another reader finds."""
    return Warehouse(wh.spark, wh.root, wh.source)


def tables(wh):
    """Silver, quarantine, measures and accepted ids, without times of writing."""
    reader = again(wh)
    ids = reader.accepted_ids()
    found = {
        "silver": reader.dated("silver/transactions").select("transaction_id", "date", "_signed_amount"),
        "quarantine": reader.dated("quarantine/transactions").select("transaction_id", "date", "_rejection_reason"),
        "measures": steps.daily_measures(reader).select("date", "transaction_date", "silver_rows", "total_signed_amount"),
        "ids": ids if ids is not None else wh.spark.createDataFrame([], "transaction_id string, date date"),
    }
    return {name: sorted(tuple(map(str, row)) for row in rows.collect()) for name, rows in found.items()}


class Killed(BaseException):
    """Ends a run as a lost driver does."""


def test_a_promotion_that_ends_anywhere_leaves_the_tables_of_one_commit(wh, monkeypatch):
    sample.write_codes(wh.source)
    lines = [f"T{n},ACC-001,2024-01-01,10.00,{code},M,ONLINE" for n, code in enumerate(("PURCH01", "LATER", "PURCH01"))]
    sample.write_day(wh.source, "2024-01-01", lines, [sample.account_line(1, "1.00")])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    before = tables(wh)
    assert [len(before[name]) for name in ("silver", "quarantine", "measures", "ids")] == [2, 1, 1, 2]
    codes = wh.snapshot("silver/transaction_codes")
    more = codes.where("transaction_code = 'PURCH01'").withColumn("transaction_code", F.lit("LATER"))
    wh.publish_snapshot(codes.unionByName(more), "silver/transaction_codes", "x")

    left, calls = None, []
    write_files, write_table, claim = DataFrameWriter.parquet, DataFrameWriter.insertInto, Commits.claim

    def step(name, act):
        def counted(*args, **kwargs):
            calls.append(name)
            if len(calls) > left:
                raise Killed
            return act(*args, **kwargs)

        return counted

    monkeypatch.setattr(DataFrameWriter, "parquet", step("files", write_files))
    monkeypatch.setattr(DataFrameWriter, "insertInto", step("ids", write_table))
    monkeypatch.setattr(Commits, "claim", step("commit", claim))
    monkeypatch.setattr(Change, "abandon", lambda change: None)  # a lost driver cleans nothing up
    batch = steps.Batch(sample.day(1), sample.day(1), "again")
    for left in range(20):
        calls.clear()
        run = again(wh)
        try:
            steps.promote_transactions(run, batch)
            break
        except Killed:
            assert tables(wh) == before
    assert calls[-1] == "commit" and "ids" in calls and len(calls) >= 5 and left == len(calls)
    after = tables(wh)
    assert [len(after[name]) for name in ("silver", "quarantine", "measures", "ids")] == [3, 0, 1, 3]
    # Earlier attempts left folders that no commit names.
    assert again(wh).clean() and tables(wh) == after and again(wh).unreferenced() == []


def test_a_repeated_stream_batch_changes_nothing(wh, monkeypatch):
    sample.write_codes(wh.source)
    sample.write_day(wh.source, "2024-01-01", ["T1,ACC-001,2024-01-01,1.00,PURCH01,M,ONLINE"], [])
    rows = bronze_rows(wh.spark, [f"{wh.source}/transactions_2024-01-01.csv"], steps.schemas.SOURCE_TRANSACTIONS, "r")
    write, claim = append_new_dates(wh, "transactions", "r"), Commits.claim

    def lost(*args):
        raise Killed

    monkeypatch.setattr(Commits, "claim", lost)  # after the files are written, before they are current
    with pytest.raises(Killed):
        write(rows, 0)
    monkeypatch.setattr(Commits, "claim", claim)
    assert again(wh).dated("bronze/transactions").count() == 0 and again(wh).appended("pipeline/loads").count() == 0
    for _ in range(2):
        write(rows, 0)
        assert again(wh).dated("bronze/transactions").count() == again(wh).appended("pipeline/loads").count() == 1
    # A run of another reader moves the tables on; the stream follows them.
    sample.write_week(wh.source, [2])
    steps.load_codes(again(wh), "other")
    later = bronze_rows(wh.spark, [f"{wh.source}/transactions_2024-01-02.csv"], steps.schemas.SOURCE_TRANSACTIONS, "r")
    write(later, 1)
    assert again(wh).dated("bronze/transactions").count() == 6 and again(wh).has_snapshot("silver/transaction_codes")


def test_every_row_is_written_once_and_counted_on_the_way(wh, monkeypatch):
    sample.write_week(wh.source, [1, 2])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    run, batch = again(wh), steps.Batch(sample.day(2), sample.day(2), "x")
    steps.load_bronze(run, batch, "transactions", steps.schemas.SOURCE_TRANSACTIONS)
    written = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **k: written.append(path) or write(self, path, **k))
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.count", lambda self: pytest.fail("a count job"))
    accepted, rejected = steps.promote_transactions(run, batch)
    assert (accepted, rejected) == ({sample.day(2): 4}, {sample.day(2): 1})
    assert sum("settled/transactions" in path for path in written) == 1
    assert not any("silver/transactions" in path or "quarantine/transactions" in path for path in written)


def test_an_increment_rewrites_the_buckets_of_its_accounts(wh):
    sample.write_codes(wh.source)
    sample.write_day(wh.source, "2024-01-01", [], [sample.account_line(n, f"{n}.00") for n in range(1, 41)])
    sample.write_day(wh.source, "2024-01-02", [], [sample.account_line(7, "700.00")])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    before = dict(wh.state.parts[wh.ACCOUNTS])
    assert len(before) == wh.buckets() > 1 and sum(n for _, n in before.values()) == 40
    run_id = runs.incremental(wh)
    after = wh.state.parts[wh.ACCOUNTS]
    changed = {bucket for bucket in after if after[bucket][0] != before[bucket][0]}
    own = wh.accounts().where("account_id = 'ACC-007'").select(wh.bucket()).first()[0]
    assert changed == {str(own)} and after[str(own)][1] == before[str(own)][1]
    balances = {r.account_id: r.current_balance for r in again(wh).accounts().collect()}
    assert len(balances) == 40 and balances["ACC-007"] == 700 and balances["ACC-008"] == 8
    log = runs.log_of(wh, run_id).where("model_name = 'silver_accounts'").first()
    assert (log.records_processed, log.records_written) == (1, 40)


def test_rows_outside_the_partitions_are_an_error(wh):
    rows = wh.spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2))], "x string, date date")
    with pytest.raises(ValueError, match="outside"):
        wh.counted_write(rows, "t/b=1", ["date"], [(dt.date(2024, 1, 1),)])


def test_counts_of_more_partitions_than_are_observed(wh, monkeypatch):
    monkeypatch.setattr(warehouse, "COUNTED", 1)
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    rows = wh.spark.createDataFrame([("a", days[0]), ("b", days[0])], "x string, date date")
    assert wh.counted_write(rows, "t/b=1", ["date"], [(d,) for d in days]) == {(days[0],): 2, (days[1],): 0}
    assert wh.counted_write(rows.where("false"), "t/b=2", ["date"], [(d,) for d in days]) == {(d,): 0 for d in days}


def test_of_two_runs_from_one_watermark_one_commits(wh, monkeypatch):
    sample.write_week(wh.source, [1, 2])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    slow, load = again(wh), steps.load_bronze
    finished = []

    def overtaken(run, *args):
        if run is slow and not finished:
            finished.append(runs.incremental(wh))  # the other run starts later and ends first
        return load(run, *args)

    monkeypatch.setattr(steps, "load_bronze", overtaken)
    with pytest.raises(ConcurrentRun):
        runs.incremental(slow)
    assert control.get_watermark(again(wh)) == sample.day(2)
    assert again(wh).dated("silver/transactions").count() == 8
    log = again(wh).appended("pipeline/run_log").where("target_date = '2024-01-02'").collect()
    assert {(r.run_id == finished[0], r.status) for r in log} == {(True, "SUCCESS"), (False, "FAILED"), (False, "SKIPPED")}
    found = verify.suite(again(wh), "2024-01-01", "2024-01-02").where("violations > 0").collect()
    assert found == []


def test_a_commit_needs_the_next_free_number(wh):
    commits = wh.commits
    commits.claim(State().next("a"))
    with pytest.raises(ConcurrentRun):
        commits.claim(State().next("b"))
    assert (commits.latest().number, commits.latest().run_id) == (1, "a")
    for _ in range(30):
        commits.claim(commits.latest().next("c"))
    assert commits.latest().number == 31 and len(commits.numbers()) == 10
    assert [name for name in commits.files.names(commits.folder) if name.startswith("_draft")] == []


def test_many_appends_keep_few_files(wh):
    for n in range(200):
        wh.append("pipeline/weeks", [(sample.day(1) + dt.timedelta(days=7 * n), None, None, f"r{n}")], f"r{n}")
    assert again(wh).appended("pipeline/weeks").select("computed_by_run_id").distinct().count() == 200
    files = [f for _, _, names in os.walk(wh.path("pipeline/weeks")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * warehouse.APPENDED_BATCHES + 2


def promoted_days(wh, days):
    sample.write_week(wh.source, days)
    runs.historical(wh, str(sample.day(days[0])), str(sample.day(days[0])))
    for _ in days[1:]:
        runs.incremental(wh)


def test_merged_ledger_keeps_the_ids(wh, monkeypatch):
    monkeypatch.setattr(warehouse, "MERGED", 2)
    promoted_days(wh, [1, 2, 3, 4])
    silver = {(r.transaction_id, r.date) for r in wh.dated("silver/transactions").select("transaction_id", "date").collect()}
    assert {tuple(r) for r in wh.accepted_ids().collect()} == silver
    classes = sorted(folder.split("/batch=")[1].split("-")[0] for folder in wh._ledger_dates())
    assert classes == ["2"]
    others = {tuple(r) for r in wh.accepted_ids(without=[sample.day(2)]).collect()}
    assert others == {pair for pair in silver if pair[1] != sample.day(2)}
    # A date that is promoted again leaves its ids in the merged batch without effect.
    runs.historical(wh, "2024-01-02", "2024-01-02")
    assert {tuple(r) for r in wh.accepted_ids().collect()} == silver


def history_side(plan):
    """Lines between the scan of the ledger and the join above it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "accepted_ids" in line)
    depth = lambda line: re.search(r"\w", line).start()
    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            found.append(line)
            if "Join" in line:
                return found
    raise AssertionError("no join above the ledger")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_history_is_not_exchanged(spark, tmp_path, threshold):
    """The plan of the staged job that searches the batch's ids in the history."""
    ledger = IdLedger(spark, str(tmp_path / "ids"), 4)
    old = spark.range(50_000).selectExpr("cast(id as string) as transaction_id", "date'2024-01-01' as date")
    ledger.add(old, "0-a")
    ledger.add(old.where("transaction_id like '1%'").withColumn("date", F.lit(dt.date(2024, 1, 2))), "0-b")
    history = ledger.ids({"0-a": None, "0-b": [dt.date(2024, 1, 2)]})
    new = spark.range(40_000, 60_000).selectExpr("cast(id as string) as transaction_id", "date'2024-01-03' as date", "id % 3 > 0 as _ok")
    plans = []

    def stage(rows, name):
        path = str(tmp_path / name)
        rows.write.parquet(path)
        plans.append((name, rows._jdf.queryExecution().executedPlan().toString()))
        return spark.read.schema(rows.schema).parquet(path)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        blocked = stage(txn.blocked_ids(new, history, F.col("date"), stage), "blocked_ids")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert blocked.where("_in_history").count() == 10_000
    side = history_side(dict(plans)["blocked_ids"])
    assert not any("Exchange" in line for line in side)
    if threshold == "-1":
        assert "SortMergeJoin" in side[-1]
