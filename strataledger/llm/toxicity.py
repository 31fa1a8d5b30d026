"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary documents.

Both models are interpolated word bigrams. A class's bigram counts are discounted and interpolated with its
word counts, and those with the continuation counts of both classes together (in how many different
words' company a word was seen). An expression whose rates in the two classes do not differ with enough
evidence, which holds for every rare one, gives its whole count to the level below; so it is judged by the
shared counts and says next to nothing about either class. How much evidence that takes is chosen on training folds.
An expression counts once per text, so that repeated lines do not outvote the rest.

A text's two log-likelihoods, length-normalised in three ways (a word, by the root of the length, and whole), go
through a logistic calibration that is fitted on folds the counts have not seen.

Training is bounded by ``TRAIN_ROWS`` labelled documents, of which it reads every word. Scoring reads every word too.

Defined results: a null or empty text has no words and gets what calibration gives to no evidence.
Repeated rows are scored repeatedly. An empty table gives no rows. Without training rows of both classes in
every fold the score is the smoothed share of label 1.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataledger.llm.common import blocks, record_batch, utf8
from strataledger.llm.samples import labelled_sample

TRAIN_ROWS = 5000
DISCOUNT = 0.75
# Thresholds on the likelihood-ratio statistic of an expression's document counts.
EVIDENCE = (6.0, 11.0, 20.0, 40.0)
# An expression in fewer training texts cannot reach the lowest threshold.
FEWEST = 4
FOLDS = 3
FEATURES = 4


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words without punctuation at their ends."""
    return [w for w in (w.strip(b".,;:!?\"'()[]*#&%$|<>") for w in text.lower().split()) if w]


@dataclass
class Model:
    # Natural logarithms of (toxic, ordinary) probabilities of words, without and with a known predecessor.
    single: dict = field(default_factory=dict)
    pair: dict = field(default_factory=dict)
    kept: dict = field(default_factory=dict)  # predecessor: share that goes to the level below, per class
    unseen: tuple[float, float] = (0.0, 0.0)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    scale: np.ndarray = field(default_factory=lambda: np.ones(FEATURES))


def expressions(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    """Different (predecessor, word) pairs of a text; the first word's predecessor is empty."""
    return set(zip([b"", *words], words))


@dataclass
class Counts:
    """Documents per expression, word and head; index 0 counts toxic documents, index 1 ordinary ones."""

    pairs: tuple[Counter, Counter] = field(default_factory=lambda: (Counter(), Counter()))
    words: tuple[Counter, Counter] = field(default_factory=lambda: (Counter(), Counter()))
    heads: tuple[Counter, Counter] = field(default_factory=lambda: (Counter(), Counter()))
    documents: list[int] = field(default_factory=lambda: [0, 0])

    def add(self, found: set, frequent: set, label: int) -> None:
        c = 1 - int(label)
        self.pairs[c].update(found & frequent)
        self.words[c].update({word for _, word in found})
        self.heads[c].update(head for head, _ in found)
        self.documents[c] += 1


def evidence(toxic: int, ordinary: int, documents: list[int]) -> float:
    """Likelihood-ratio statistic of two document counts against equal rates."""
    share = (toxic + ordinary) / sum(documents)
    return 2 * sum(n * math.log(n / (share * size)) for n, size in zip((toxic, ordinary), documents) if n)


def telling(counts: tuple[Counter, Counter], documents: list[int]) -> dict:
    """Expressions with evidence above the lowest threshold, with that evidence."""
    found = {}
    for expression in set(counts[0]) | set(counts[1]):
        toxic, ordinary = counts[0][expression], counts[1][expression]
        if toxic + ordinary >= FEWEST and (strength := evidence(toxic, ordinary, documents)) >= EVIDENCE[0]:
            found[expression] = strength
    return found


def kneser_ney(counts: Counts, shared: Counter, words: dict, pairs: dict, bound: float) -> Model:
    """Probabilities of both classes, with class counts only of the expressions above ``bound``.

    ``shared`` has each word's continuation count in all texts, whatever their class.
    """
    model = Model()
    total = sum(shared.values()) + 1  # one share for all words that training lacks
    known = [w for w, strength in words.items() if strength >= bound]
    sizes = [max(1, sum(own.values())) for own in counts.words]
    rests = [1 - sum(max(own[w] - DISCOUNT, 0) for w in known) / size for own, size in zip(counts.words, sizes)]
    model.unseen = tuple(math.log(rest / total) for rest in rests)
    model.single = {w: tuple(math.log(rest * n / total) for rest in rests) for w, n in shared.items() if n > 1}
    for word in known:
        model.single[word] = tuple(
            math.log(max(own[word] - DISCOUNT, 0) / size + rest * shared[word] / total)
            for own, size, rest in zip(counts.words, sizes, rests)
        )
    often = [p for p, strength in pairs.items() if strength >= bound]
    heads = {head for head, _ in often}
    sums = counts.heads
    taken = [Counter(), Counter()]
    for pair in often:
        for c in (0, 1):
            taken[c][pair[0]] += max(counts.pairs[c][pair] - DISCOUNT, 0)
    rest_of = {h: tuple(1 - taken[c][h] / max(1, sums[c][h]) for c in (0, 1)) for h in heads}
    model.kept = {h: tuple(map(math.log, rest)) for h, rest in rest_of.items()}
    for head, word in often:
        model.pair[head, word] = tuple(
            math.log(
                max(counts.pairs[c][head, word] - DISCOUNT, 0) / max(1, sums[c][head])
                + rest_of[head][c] * math.exp(model.single.get(word, model.unseen)[c])
            )
            for c in (0, 1)
        )
    return model


def log_likelihoods(model: Model, found: set | frozenset) -> tuple[float, float, int]:
    """Toxic and ordinary log-likelihood of a text's expressions, and their number."""
    toxic = ordinary = 0.0
    single, pair, kept, unseen = model.single, model.pair, model.kept, model.unseen
    for expression in found:
        head, word = expression
        both = pair.get(expression)
        if both is None:
            both = single.get(word, unseen)
            if head in kept:
                below = kept[head]
                both = both[0] + below[0], both[1] + below[1]
        toxic += both[0]
        ordinary += both[1]
    return toxic, ordinary, len(found)


def features(toxic, ordinary, sizes) -> np.ndarray:
    sizes = np.maximum(np.asarray(sizes, np.float64), 1)
    ratio = np.asarray(toxic, np.float64) - np.asarray(ordinary, np.float64)
    return np.stack([ratio / sizes, ratio / np.sqrt(sizes), ratio, np.log(sizes)], 1)


def calibrated(model: Model, rows: np.ndarray) -> np.ndarray:
    activation = (rows / model.scale) @ model.weights[:-1] + model.weights[-1]
    return 1 / (1 + np.exp(-np.clip(activation, -40, 40)))


def fit_logistic(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Newton's method with a small ridge: weights, feature scales and mean log loss."""
    scale = np.maximum(rows.std(axis=0), 1e-9)
    data = np.hstack([rows / scale, np.ones((len(rows), 1))])
    weights = np.zeros(data.shape[1])
    ridge = np.full(data.shape[1], 0.1)
    for _ in range(30):
        guess = 1 / (1 + np.exp(-np.clip(data @ weights, -40, 40)))
        gradient = data.T @ (guess - labels) + ridge * weights
        curve = (data * (guess * (1 - guess))[:, None]).T @ data + np.diag(ridge)
        change = np.linalg.solve(curve, gradient)
        weights = weights - np.clip(change, -5, 5)
    guess = np.clip(1 / (1 + np.exp(-np.clip(data @ weights, -40, 40))), 1e-12, 1 - 1e-12)
    loss = -np.mean(labels * np.log(guess) + (1 - labels) * np.log(1 - guess))
    return weights, scale, float(loss)


def train(documents: Iterable[list[bytes]], labels: np.ndarray) -> Model:
    """Texts of one label with the same set of expressions count once; every other labelled text is learned from."""
    # Texts share their words and expressions, so that the driver holds each of these once.
    words_seen, pairs_seen, unique = {}, {}, {}
    for words, label in zip(documents, labels):
        pairs = expressions([words_seen.setdefault(word, word) for word in words])
        unique.setdefault((frozenset(pairs_seen.setdefault(pair, pair) for pair in pairs), int(label)), label)
    sets, labels = [found for found, _ in unique], list(unique.values())
    del words_seen, pairs_seen, unique
    labels = np.array(labels, np.float64)
    fold = np.arange(len(labels)) % FOLDS
    if any(len(set(labels[fold != f])) < 2 for f in range(FOLDS)):
        share = (labels.sum() + 1) / (len(labels) + 2)
        model = Model(unseen=(-1.0, -1.0))
        model.weights[-1] = math.log(share / (1 - share))
        return model
    together = Counter(e for found in sets for e in found)
    shared = Counter(word for _, word in together)
    frequent = {e for e, n in together.items() if n >= FEWEST}
    del together

    def counted(rows) -> tuple[Counts, Counter, dict, dict]:
        counts = Counts()
        for i in rows:
            counts.add(sets[i], frequent, labels[i])
        return counts, shared, telling(counts.words, counts.documents), telling(counts.pairs, counts.documents)

    rows = {bound: np.zeros((len(labels), FEATURES)) for bound in EVIDENCE}
    for f in range(FOLDS):
        counts = counted(np.where(fold != f)[0])
        own = np.where(fold == f)[0]
        for bound in EVIDENCE:
            model = kneser_ney(*counts, bound)
            rows[bound][own] = features(*np.array([log_likelihoods(model, sets[i]) for i in own]).T)
    fitted = {bound: fit_logistic(rows[bound], labels) for bound in EVIDENCE}
    best = min(EVIDENCE, key=lambda bound: fitted[bound][2])
    model = kneser_ney(*counted(range(len(labels))), best)
    model.weights, model.scale = fitted[best][:2]
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Train on the bounded sample: the words of at most TRAIN_ROWS texts come to the driver."""
    sample = labelled_sample(docs, labels, label, TRAIN_ROWS)

    def cut(batches):
        for batch in blocks(batches):
            texts = [b" ".join(words_of(t)) for t in utf8(batch.column("text"))]
            schema = pa.schema([("doc_id", batch.column("doc_id").type), ("label", pa.int32()), ("words", pa.binary())])
            yield record_batch(schema, [batch.column("doc_id"), batch.column("label"), texts])

    doc_type = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(cut, f"doc_id {doc_type}, label int, words binary").toArrow().sort_by("doc_id")
    documents = (text.as_py().split() for text in rows.column("words"))
    return train(documents, rows.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns doc_id, toxic_ll and ordinary_ll (natural logarithms, per expression) and score, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the training bounds limit its size

    def run(batches):
        own = shared.value
        for batch in blocks(batches):
            texts = utf8(batch.column("text"))
            likely = np.array([log_likelihoods(own, expressions(words_of(t))) for t in texts], np.float64).reshape(-1, 3)
            each = likely / np.maximum(likely[:, 2:], 1)
            schema = pa.schema(
                [("doc_id", batch.column("doc_id").type)]
                + [(name, pa.float64()) for name in ("toxic_ll", "ordinary_ll", "score")]
            )
            result = calibrated(own, features(*likely.T))
            yield record_batch(schema, [batch.column("doc_id"), each[:, 0], each[:, 1], result])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    names = "toxic_ll double, ordinary_ll double, score double"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, {names}")
