"""Quoting, amounts and row order of source files, and re-runs of older ones."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
import sample

from strataledger import schemas
from strataledger.operators import checks
from strataledger.plans import control, runs, steps, verify
from strataledger.plans.runs import RunOptions
from strataledger.sources.files import read_csv, whole_rows
from strataledger.sources.warehouse import Warehouse
from strataledger.streaming import file_stream


def warehouse(spark, folder, **options):
    source = folder / "source"
    source.mkdir(parents=True)
    sample.write_codes(source)
    return Warehouse(spark, str(folder / "root"), str(source), **options)


def line(id_, merchant="M", amount="10.00", account="ACC-001"):
    return f"{id_},{account},2024-01-01,{amount},PURCH01,{merchant},ONLINE"


def test_quotes_empty_texts_and_amounts(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    rows = [
        line("A", '"Joe ""The, Grill"" Co"'), line("B", '""'), line("C", amount="5.005"), line("D", amount="5.0100"), line("E", amount="x"),
        line('"F,1"', "last"),
    ]
    sample.write_day(wh.source, "2024-01-01", rows, [sample.account_line(1, "1.00")])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    kept = {r.transaction_id: (r.merchant_name, r.amount) for r in wh.dated("silver/transactions").collect()}
    assert kept == {
        "A": ('Joe "The, Grill" Co', Decimal("10.00")), "B": (None, Decimal("10.00")), "D": ("M", Decimal("5.01")), "F,1": ("last", Decimal("10.00")),
    }
    lost = {r.transaction_id: r._rejection_reason for r in wh.dated("quarantine/transactions").collect()}
    assert lost == {"C": "NULL_REQUIRED_FIELD", "E": "NULL_REQUIRED_FIELD"}


def test_line_breaks_in_quotes(spark, tmp_path):
    rows = [line("A", '"two\nlines"'), line("B")]
    strict = warehouse(spark, tmp_path / "strict", strict=True)
    sample.write_day(strict.source, "2024-01-01", rows, [sample.account_line(1, "1.00")])
    with pytest.raises(Exception, match="wrong number of fields"):
        runs.historical(strict, "2024-01-01", "2024-01-01")
    assert strict.dated("silver/transactions").count() == 0
    with pytest.raises(Exception, match="wrong number of fields"):
        whole_rows(read_csv(spark, f"{strict.source}/transactions_2024-01-01.csv", schemas.SOURCE_TRANSACTIONS)).select("channel").collect()
    loose = warehouse(spark, tmp_path / "loose", multiline=True)
    sample.write_day(loose.source, "2024-01-01", rows, [sample.account_line(1, "1.00")])
    runs.historical(loose, "2024-01-01", "2024-01-01")
    assert {r.merchant_name for r in loose.dated("silver/transactions").collect()} == {"two\nlines", "M"}


@pytest.mark.parametrize("kind", ["batch", "stream"])
def test_a_broken_row_is_kept_beside_the_others(spark, tmp_path, kind):
    wh = warehouse(spark, tmp_path)
    rows = [line("A"), "B,ACC-001,2024-01-01", line("C") + ",one,too,many", line("D")]
    sample.write_day(wh.source, "2024-01-01", rows, [sample.account_line(1, "1.00")])
    sample.write_day(wh.source, "2024-01-02", ["only this"], [sample.account_line(1, "2.00")])
    if kind == "stream":
        for entity, schema in (("accounts", schemas.SOURCE_ACCOUNTS), ("transactions", schemas.SOURCE_TRANSACTIONS)):
            file_stream.ingest_available(wh, entity, schema, str(tmp_path / "marks" / entity)).awaitTermination()
    run_id = runs.historical(wh, "2024-01-01", "2024-01-02")
    assert sorted(r.transaction_id for r in wh.dated("silver/transactions").collect()) == ["A", "D"]
    broken = wh.dated("bronze/broken_transactions").orderBy("date", "_source_position").collect()
    assert [(r._broken_row, r._source_file) for r in broken] == [
        (rows[1], "transactions_2024-01-01.csv"), (rows[2], "transactions_2024-01-01.csv"), ("only this", "transactions_2024-01-02.csv"),
    ]
    assert len({r._source_position for r in broken[:2]}) == 2
    loads = {(r.entity, r.date.day): (r.records_written, r.records_broken) for r in wh.appended("pipeline/loads").collect()}
    assert loads[("transactions", 1)] == (2, 2) and loads[("transactions", 2)] == (0, 1) and loads[("accounts", 1)] == (1, 0)
    log = runs.log_of(wh, run_id).where("model_name = 'bronze_transactions' and target_date = '2024-01-01'").first()
    if kind == "batch":
        assert (log.records_processed, log.records_written, log.records_rejected) == (4, 2, 2)
    assert violated(wh) == set()


def test_accounting_stops_a_promotion_before_it_is_visible(spark, tmp_path, monkeypatch):
    wh = warehouse(spark, tmp_path)
    sample.write_week(wh.source, [1])
    counted = Warehouse.rows_of
    monkeypatch.setattr(Warehouse, "rows_of", lambda self, name, values: {v: n + (name == "bronze/transactions") for v, n in counted(self, name, values).items()})
    with pytest.raises(steps.DataQualityError, match="bronze rows"):
        runs.historical(wh, "2024-01-01", "2024-01-01")
    assert wh.dated("silver/transactions").count() == wh.dated("quarantine/transactions").count() == 0
    assert wh.accepted_ids() is None and control.get_watermark(wh) is None
    assert not any("settled" in folder for folder in wh.unreferenced())


def test_stream_and_batch_keep_the_same_rows(spark, tmp_path):
    """One file with every id three times, read in many small splits."""
    rows = [line(f"T{i}", f"send {n}") for n in range(3) for i in range(2000)]
    accounts = [sample.account_line(1, f"{n}.00") for n in range(500)]
    found = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        for kind in ("batch", "stream"):
            wh = warehouse(spark, tmp_path / kind)
            sample.write_day(wh.source, "2024-01-01", rows, accounts)
            if kind == "stream":
                for entity, schema in (("accounts", schemas.SOURCE_ACCOUNTS), ("transactions", schemas.SOURCE_TRANSACTIONS)):
                    file_stream.ingest_available(wh, entity, schema, str(tmp_path / "marks" / entity)).awaitTermination()
            runs.historical(wh, "2024-01-01", "2024-01-01")
            silver = wh.dated("silver/transactions")
            found.append((silver.count(), silver.where("merchant_name = 'send 0'").count(), wh.accounts().first().current_balance))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [(2000, 2000, Decimal("499.00"))] * 2


def test_an_older_range_again_changes_nothing(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    sample.write_week(wh.source, range(1, 4))
    options = RunOptions(days_per_batch=1)
    runs.historical(wh, "2024-01-01", "2024-01-03", options)
    before, mark = verify.digests(wh), control.get_watermark(wh)
    for start, end in (("2024-01-01", "2024-01-01"), ("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-02")):
        runs.historical(wh, start, end, options)
        assert verify.digests(wh) == before
        assert control.get_watermark(wh) == mark == dt.date(2024, 1, 3)


def test_null_codes_have_no_effect(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    sample.write_file(wh.source, "transaction_codes.csv", sample.CODE_HEADER, [*sample.CODES, ",x,DR,FEE,true", ",y,DR,FEE,true"])
    sample.write_day(wh.source, "2024-01-01", [line("A")], [sample.account_line(1, "1.00")])
    runs.historical(wh, "2024-01-01", "2024-01-01")
    assert wh.dated("silver/transactions").count() == 1


def test_every_successful_step_says_how_many_rows_it_read(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    sample.write_week(wh.source, range(1, 3))
    log = runs.log_of(wh, runs.historical(wh, "2024-01-01", "2024-01-02")).collect()
    assert all(r.records_processed is not None for r in log if r.status == "SUCCESS") and len(log) == 2 + 8 + 2
    read = {r.model_name: r.records_processed for r in log}
    assert (read["silver_accounts"], read["gold_daily_summary"]) == (3, 8)


def test_unreadable_control_state_halts_with_a_log_row(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    sample.write_week(wh.source, range(1, 3))
    runs.historical(wh, "2024-01-01", "2024-01-01")
    two = wh.frame([(dt.date(2024, 1, 1), None, "a"), (dt.date(2024, 1, 2), None, "b")], schemas.CONTROL)
    wh.publish_snapshot(two, "pipeline/control", "broken")
    with pytest.raises(Exception, match="more than one row"):
        runs.incremental(wh)
    assert wh.appended("pipeline/run_log").where("model_name = 'CONTROL_PLANE' and status = 'FAILED'").count() == 1


def violated(wh, start="2024-01-01", end="2024-01-02"):
    return {r["check"] for r in verify.suite(wh, start, end).where("violations > 0").collect()}


def test_lost_partitions_and_late_rows(spark, tmp_path):
    """A lost bronze partition is seen on its date; rows that come after their week was computed are no fault."""
    wh = warehouse(spark, tmp_path)
    sample.write_week(wh.source)
    runs.historical(wh, "2024-01-01", "2024-01-07")
    late = [line("LATE").replace("2024-01-01", "2024-01-03")]
    sample.write_day(wh.source, "2024-01-08", late, [])
    runs.incremental(wh)
    assert violated(wh, "2024-01-01", "2024-01-07") == set()
    rows = wh.dated("bronze/accounts").where("date = '2024-01-02'")
    wh.publish_partitions(rows.limit(0), "bronze/accounts", "date", [dt.date(2024, 1, 2)])
    assert violated(wh) == {"bronze_accounts_complete"}


def test_digest_sees_where_a_null_stands(spark):
    kind = "a string, b string, s struct<x:double,y:string>"
    tables = [[(None, "a", (0.0, None))], [("a", None, (0.0, None))], [(None, "a", (None, "0"))]]
    digests = {tuple(checks.content_digest(spark.createDataFrame(rows, kind)).first()) for rows in tables}
    assert len(digests) == 3
    zero = [checks.content_digest(spark.createDataFrame([("a", "b", (x, None))], kind)).first() for x in (0.0, -0.0)]
    assert zero[0] == zero[1]
