"""Arriving files as a stream."""

from __future__ import annotations

import sample

from strataledger.plans import control, runs
from strataledger.schemas import SOURCE_ACCOUNTS, SOURCE_TRANSACTIONS
from strataledger.sources.warehouse import Warehouse
from strataledger.streaming import file_stream


def test_stream_fills_bronze_and_increments_follow(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    wh = Warehouse(spark, str(tmp_path / "root"), str(source))

    def ingest():
        for entity, schema in (("accounts", SOURCE_ACCOUNTS), ("transactions", SOURCE_TRANSACTIONS)):
            file_stream.ingest_available(wh, entity, schema, str(tmp_path / "checkpoints" / entity)).awaitTermination()

    sample.write_week(source, [1, 2])
    ingest()
    assert wh.dated("bronze/transactions").count() == 10
    assert wh.dated("bronze/accounts").count() == 5
    assert [str(d) for d in file_stream.pending_dates(wh)] == ["2024-01-01", "2024-01-02"]
    assert file_stream.promote_available(wh) is None
    runs.historical(wh, "2024-01-01", "2024-01-01")
    assert wh.dated("bronze/transactions").count() == 10
    ingest()
    assert wh.dated("bronze/transactions").count() == 10
    sample.write_week(source, [3])
    ingest()
    assert wh.dated("bronze/transactions").count() == 15
    run_id = file_stream.promote_available(wh)
    promoted = runs.log_of(wh, run_id).where("model_name = 'silver_transactions'").select("target_date").collect()
    assert sorted(r.target_date for r in promoted) == ["2024-01-02", "2024-01-03"]
    assert file_stream.promote_available(wh) is None
    assert control.get_watermark(wh) == sample.day(3)
    daily = {r.transaction_date: r.total_transactions for r in wh.snapshot("gold/daily_summary").collect()}
    assert daily == {sample.day(n): 3 for n in (1, 2, 3)}
    assert file_stream.pending_dates(wh) == []
