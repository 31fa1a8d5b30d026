"""The pipeline on one small corpus, stage by stage."""

import corpus_pipeline
import pytest

from strataledger.llm.common import stored, tuned

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    tuned(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = tables[name] = stored(stage(spark, docs, SF), name)
    return tables


def test_order_and_columns(stages):
    assert list(stages) == ["documents", "quality", "near_dedup", "decontamination", "pii", "packing"]
    for name in list(stages)[1:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_decisions_take_effect(spark, stages):
    rows = {name: {r["doc_id"]: r for r in t.collect()} for name, t in stages.items() if name != "packing"}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(rows["documents"]) - set(rows["quality"])
    assert gone and sum(labels.get(i, 0) == 1 for i in gone) <= 1
    assert set(rows["pii"]) == set(rows["decontamination"]) < set(rows["near_dedup"]) < set(rows["quality"])
    assert any("<email>" in r["text"] or "<ip>" in r["text"] for r in rows["pii"].values())
    assert all(r["n_chars"] == len(r["text"]) for r in rows["pii"].values())
    packed = stages["packing"].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r["doc_id"] for r in packed} == set(rows["pii"])
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in packed)


def test_null_texts_and_empty_tables(spark, documents):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    odd = documents([(1, None), (2, ""), (None, None), (3, "a b")]).select(*base.columns)
    for docs, pieces in ((base, 0), (odd, 4)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == pieces
