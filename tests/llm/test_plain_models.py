"""The trained operators against plain forms of their models, and training on whole texts."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataledger.llm import language, personal_data, quality_cnn, toxicity

SF = "/root/testdata/sf0.01"


def plain_probability(net, text):
    """The network by loops over chunks, windows, filters and positions."""
    data = text.ljust(max(len(text), quality_cnn.WIDTH), b"\0")
    chunks = [data[s : s + quality_cnn.CHUNK] for s in quality_cnn.chunk_starts(len(data))]
    pooled = []
    for chunk in chunks:
        largest = [
            max(
                sum(float(net.tables[p, chunk[w + p], f]) for p in range(quality_cnn.WIDTH))
                for w in range(len(chunk) - quality_cnn.WIDTH + 1)
            )
            for f in range(quality_cnn.FILTERS)
        ]
        pooled.append([max(0.0, x + float(o)) for x, o in zip(largest, net.offset)])
    columns = list(zip(*pooled))
    size = max(1, len(text))
    sized = [min(size / bound, 1) for bound in (256, 64, 16)] + [math.log(size) / 10]
    features = [x * sized[0] for x in [*(sum(c) / len(c) for c in columns), *map(max, columns), *map(min, columns)]] + sized
    return 1 / (1 + math.exp(-(sum(a * float(b) for a, b in zip(features, net.weights)) + net.bias)))


def test_quality_equals_plain_network(documents, spark):
    net = quality_cnn.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    rng = random.Random(4)
    texts = ["", "a", "short text", "é" * 700, "".join(rng.choice("abc de.\n1") for _ in range(1500))]
    found = {r["doc_id"]: r["score"] for r in quality_cnn.score(documents(list(enumerate(texts))), net).collect()}
    for number, text in enumerate(texts):
        assert found[number] == pytest.approx(plain_probability(net, text.encode()), abs=1e-4)


def plain_log_likelihood(model, words, c):
    """A text's expressions one by one: the pair's probability, or the predecessor's rest times the word's."""
    total = 0.0
    for head, word in set(zip([b"", *words], words)):
        if (head, word) in model.pair:
            total += model.pair[head, word][c]
        else:
            total += model.single.get(word, model.unseen)[c] + model.kept.get(head, (0.0, 0.0))[c]
    return total


def test_toxicity_equals_plain_sums(documents, spark):
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    texts = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).select("doc_id", "text")
    found = {r["doc_id"]: r for r in toxicity.score(texts, model).collect()}
    for row in texts.collect():
        words = toxicity.words_of((row["text"] or "").encode())
        n = max(1, len(set(zip([b"", *words], words))))
        toxic, ordinary = (plain_log_likelihood(model, words, c) for c in (0, 1))
        assert found[row["doc_id"]]["toxic_ll"] == pytest.approx(toxic / n) and found[row["doc_id"]]["ordinary_ll"] == pytest.approx(ordinary / n)
        inputs = [(toxic - ordinary) / n, (toxic - ordinary) / math.sqrt(n), toxic - ordinary, math.log(n)]
        activation = sum(x / s * w for x, s, w in zip(inputs, model.scale, model.weights)) + model.weights[-1]
        assert found[row["doc_id"]]["score"] == pytest.approx(1 / (1 + math.exp(-activation)), abs=1e-9)


def plain_grams(text):
    """Character n-grams of a text whose second character is a letter, with repetitions."""
    padded = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    return [padded[i : i + n] for n in language.SIZES for i in range(len(padded) - n + 1) if padded[i + 1] != " "]


def test_language_equals_exact_sets(documents, spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").orderBy("doc_id").limit(300)
    held = docs.select("doc_id", "text", "lang").collect()
    sets = {}
    for lang in {r["lang"] for r in held if r["lang"]}:
        own = [set(plain_grams(r["text"])) for r in held if r["lang"] == lang]
        least = max(1, language.SHARE * len(own))
        counts = {}
        for gram in itertools.chain.from_iterable(own):
            counts[gram] = counts.get(gram, 0) + 1
        sets[lang] = {gram for gram, n in counts.items() if n >= least}
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, language.fit(docs, F.lit(True))).collect()}
    decided = 0
    for row in held:
        grams = plain_grams(row["text"])
        ranking = sorted(((sum(g in known for g in grams), lang) for lang, known in sets.items()), reverse=True)
        # False positives of the filters may turn near ties only.
        if ranking[0][0] > ranking[1][0] + max(2, 0.01 * len(grams)):
            decided += 1
            assert found[row["doc_id"]] == ranking[0][1]
    assert decided > 200


def test_three_hundred_languages_and_unknown_texts(documents):
    rng = random.Random(8)
    words = {f"l{i:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(5)] for i in range(300)}
    rows = [(10 * i + j, " ".join(own), lang) for i, (lang, own) in enumerate(words.items()) for j in range(2 if i else 4)]
    filters = language.fit(documents(rows), F.lit(True))
    assert len(filters.languages) == 300
    asked = [(i, " ".join(reversed(own))) for i, own in enumerate(words.values())] + [(900, "日本語です"), (901, "12 !"), (902, None)]
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(documents(asked), filters).collect()}
    assert sum(found[i][0] == lang for i, lang in enumerate(words)) >= 298
    assert found[900] == ("l000", pytest.approx(4 / 602)) and found[901] == found[902] == ("und", 0.0)


def test_training_reads_texts_to_their_end(documents, spark):
    filler = " ".join(f"w{i % 50}" for i in range(3000))
    rows = [(n, f"{filler} own{n} {'vile scum' if n % 2 else 'kind soul'} end") for n in range(200)]
    labels = spark.createDataFrame([(n, n % 2, n % 2) for n in range(200)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(documents(rows), labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(documents(rows), model).collect()}
    assert all((found[n] > 0.5) == (n % 2 == 1) for n in range(200))
    sample = quality_cnn.training_chunks(quality_cnn.labelled_sample(documents(rows), labels, "quality", 500))
    for row in sample.collect():
        assert len(row["chunks"]) // quality_cnn.CHUNK == len(quality_cnn.chunk_starts(row["size"]))
        assert bytes(row["chunks"]).endswith(b"end")


def plain_spans(text):
    spans = [("email", *m.span()) for m in personal_data.EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in personal_data.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in personal_data.CARD.finditer(text):
        digits = personal_data.digits_of(m.group())
        if 13 <= len(digits) <= 19 and personal_data.luhn(digits):
            spans.append(("card", *m.span()))
    return spans + [("phone", *m.span()) for m in personal_data.PHONE.finditer(text) if 9 <= len(personal_data.digits_of(m.group())) <= 15]


def test_strict_rules_equal_the_patterns_on_random_texts():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("aA1.0-@@_% +2..59é") for _ in range(rng.randrange(25)))
        assert personal_data.strict_spans(text) == plain_spans(text)
    assert personal_data.strict_spans("0" * 30 + "1.2.3.4") == [("ip", 0, 37)]


def test_long_texts_take_proportional_time():
    finder = personal_data.fit_examples([])
    texts = {
        "digits": "7" * 1_000_000,
        "signs": "+1 " * 100_000,
        "letters": "a" * 1_000_000 + "@",
        "signed letters": "a@" * 300_000,
        "single digits": "1 " * 100_000,
        "dots": "1." * 100_000,
        "random": "".join(random.Random(1).choice("0123456789 ") for _ in range(100_000)),
    }
    for name, text in texts.items():
        start = time.process_time()
        finder.spans(text)
        assert time.process_time() - start < 20, name
