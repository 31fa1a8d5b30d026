"""Held-out accuracy of the trained operators, and their defined results on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataledger.llm import language, quality_cnn, queries, toxicity
from strataledger.llm.boosted_trees import threshold_for, train

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "word " * 40_000), (6, "\x00\x01"), (6, "\x00\x01"), (None, "1234 !!"), (8, "é" * 3000)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def accuracy(result, truth, column, where="held_out"):
    rows = result.join(truth, "doc_id").where(where).select((F.col("predicted") == F.col(column)).cast("int").alias("hit"))
    return rows.agg(F.avg("hit")).first()[0]


def test_quality_held_out(spark, labels):
    result = queries.op10_byte_cnn(spark, SF)
    assert result.columns == ["doc_id", "held_out", "score", "predicted"] and result.count() == 1000
    assert accuracy(result, labels, "quality") > 0.9


def test_toxicity_held_out(spark, labels):
    result = queries.op3_kneser_ney_toxicity(spark, SF)
    assert result.columns == ["doc_id", "held_out", "score", "predicted"] and result.count() == 1000
    assert accuracy(result, labels, "toxic") > 0.9


def test_language_held_out(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    result = queries.op8_language_filters(spark, SF)
    assert result.columns == ["doc_id", "held_out", "lang_pred", "score"] and result.count() == 1000
    assert accuracy(result.withColumnRenamed("lang_pred", "predicted"), truth, "lang") > 0.98


def test_quality_of_odd_rows(documents, labels, spark):
    net = quality_cnn.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    rows = quality_cnn.score(documents(ODD), net).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    kept = quality_cnn.accepted(documents(ODD), net, 0.0)
    assert kept.columns == documents(ODD).columns and kept.count() == len(ODD)
    assert quality_cnn.score(documents([]), net).count() == 0
    nothing = quality_cnn.fit(documents(ODD), labels.where("false"))
    assert {r["score"] for r in quality_cnn.score(documents(ODD), nothing).collect()} == {0.5}


def test_chunks_cover_every_byte():
    for size in (1, 6, 511, 512, 513, 1018, 1019, 5000):
        starts = quality_cnn.chunk_starts(size)
        windows = {w for s in starts for w in range(s, max(s + 1, min(s + quality_cnn.CHUNK, size) - quality_cnn.WIDTH + 1))}
        assert windows >= set(range(size - quality_cnn.WIDTH + 1))


def test_network_on_blocks_equals_one_by_one():
    rng = np.random.default_rng(1)
    texts = [rng.integers(32, 127, n, dtype=np.uint8).tobytes() for n in (0, 3, 600, 90_000, 512)]
    net = quality_cnn.train([np.zeros((1, 512), np.uint8), np.ones((2, 512), np.uint8)], np.array([9, 900]), np.array([0.0, 1.0]))
    together = quality_cnn.probabilities(net, texts)
    assert together == pytest.approx([quality_cnn.probabilities(net, [t])[0] for t in texts], abs=1e-6)


def test_toxicity_of_odd_rows(documents, labels, spark):
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    rows = toxicity.score(documents(ODD), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(documents([]), model).count() == 0
    one_class = toxicity.fit(documents([(n, "a b") for n in range(20)]), labels.where("toxic = 0").limit(0))
    assert {r["score"] for r in toxicity.score(documents(ODD), one_class).collect()} == {0.5}


def test_kneser_ney_is_a_distribution():
    texts = [b"you are a fool fool", b"fool you are", b"a fine day", b"a day you are fine", b"fool again", b"fine again fool"]
    documents = [toxicity.words_of(t) for t in texts] * 5
    labels = np.array([1.0, 1, 0, 0, 1, 1] * 5)
    counts, sets = toxicity.Counts(), [toxicity.expressions(d) for d in documents]
    frequent = {e for found in sets for e in found}
    for found, label in zip(sets, labels):
        counts.add(found, frequent, label)
    shared = toxicity.Counter(word for _, word in frequent)
    words, pairs = (toxicity.telling(c, counts.documents) for c in (counts.words, counts.pairs))
    model = toxicity.kneser_ney(counts, shared, words, pairs, 6.0)
    assert b"fool" in words
    vocabulary = set(shared)
    for c in (0, 1):
        listed = sum(np.exp(model.single.get(w, model.unseen)[c]) for w in vocabulary)
        once = [w for w in vocabulary if w not in model.single]
        assert listed + np.exp(model.unseen[c]) == pytest.approx(1, abs=1e-9) and all(shared[w] == 1 for w in once)


def test_language_of_odd_rows(documents):
    known = [(n, "the cat sat on the mat and then it ran", "en") for n in range(30)]
    known += [(n + 50, "der hund und die katze sind nicht hier", "de") for n in range(20)] + [(90, None, "xx"), (91, "zz", None)]
    filters = language.fit(documents(known), F.lit(True))
    assert filters.languages == ["en", "de", "xx"]
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(documents(ODD), filters).collect()}
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, None))
    rows = language.identify(documents([(1, "THE CAT ran"), (2, "die Katze"), (3, "1 2 3")]), filters).collect()
    assert [r["lang_pred"] for r in sorted(rows)] == ["en", "de", "und"]
    nothing = language.fit(documents(known), F.lit(False))
    assert {r["lang_pred"] for r in language.identify(documents(ODD), nothing).collect()} == {"und"}
    assert language.identify(documents([]), filters).count() == 0


def test_filters_hold_all_their_languages():
    rng = np.random.default_rng(5)
    grams = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    owners = rng.integers(0, 70, 3000)
    filters = language.build([f"l{i}" for i in range(70)], grams, owners)
    masks = filters.masks(grams)
    held = (masks[np.arange(3000), owners // 64] >> (owners % 64).astype(np.uint64)) & np.uint64(1)
    assert held.all()
    foreign = filters.masks(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    rate = np.mean([(foreign[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(70)], axis=1)
    assert np.abs(rate - filters.false_positives()).max() < 0.003


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    rows = rng.random((2000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.3)).astype(float)
    trees = train(rows[:1500], labels[:1500])
    likely = trees.probability(rows[1500:])
    assert ((likely > 0.5) == labels[1500:]).mean() > 0.95
    bound = threshold_for(likely, labels[1500:], 0.98)
    assert labels[1500:][likely >= bound].mean() >= 0.98
    assert threshold_for(np.array([0.2]), np.array([0.0]), 0.9) == 2.0


def test_toxicity_learns_from_every_different_text(monkeypatch):
    added = []
    add = toxicity.Counts.add
    monkeypatch.setattr(toxicity.Counts, "add", lambda self, found, frequent, label: (added.append((frozenset(found), int(label))), add(self, found, frequent, label))[1])
    common = b" ".join(b"p%d" % i for i in range(40))  # a passage that all texts share
    texts = [common + b" own%d" % i for i in range(30)]
    documents = [toxicity.words_of(t) for t in texts]
    labels = np.array([i % 2 for i in range(30)], np.float64)
    toxicity.train([*documents, documents[0], documents[1]], np.array([*labels, labels[0], 1 - labels[1]]))
    expected = {(frozenset(toxicity.expressions(d)), int(n)) for d, n in zip(documents, labels)}
    expected.add((frozenset(toxicity.expressions(documents[1])), int(1 - labels[1])))
    assert set(added[-31:]) == expected and len(expected) == 31
