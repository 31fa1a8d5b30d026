"""Language identification with bit-sliced Bloom filters.

One Bloom filter per language, stored across: a cell holds one bit per language, so one look-up of an
n-gram reads ``HASHES`` cells, and their conjunction is the mask of all languages whose filter contains the
n-gram. A text's mask bits are counted per language, the expected number of false positives is taken off
(a language's filter passes a foreign n-gram with probability fill ** HASHES), and the largest count decides.

A filter contains the character n-grams that occur in at least ``SHARE`` of the language's training texts.
Training is bounded: a hash of the id picks about ``ROWS`` texts of each language, and every language is learned.
Prediction reads whole texts, and the text only.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or when there was nothing to learn
from. A text with letters of which no n-gram is known gets the language with most training texts, with its
share of them as score. Of languages with equal counts, the one with more
training texts wins, then the first by name. Repeated rows are predicted repeatedly. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.llm.common import blocks, record_batch

SIZES = (3, 4)
HASHES = 3
CELLS_PER_GRAM = 16
SHARE = 0.004
ROWS = 2000
UNDECIDED = "und"
SPACE = 32
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def codes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code points of all texts with a space around each, other characters than letters as spaces;
    the number of the text each belongs to; and whether each text has a letter."""
    parts = [np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le", "replace"), np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    codes = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    is_letter = letters()[codes]
    with_letter = np.bincount(owner[is_letter], minlength=len(parts)) > 0
    return np.where(is_letter, codes, SPACE).astype(np.uint64), owner, with_letter


def grams_of(codes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that lie in one text and in at most two words' neighbourhood, with their text."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.full(n, size, np.uint64)
    for place in range(size):
        value = value * MIX + codes[place : place + n]
        value ^= value >> np.uint64(29)
    own = (owner[:n] == owner[size - 1 :]) & (codes[1 : n + 1] != SPACE)
    return value[own] * MIX, owner[:n][own]


@dataclass
class Filters:
    languages: list[str]
    cells: np.ndarray  # (number of cells, words of 64 languages)
    share: float = 0.0  # of the first language among the training texts

    def positions(self, grams: np.ndarray) -> list[np.ndarray]:
        step = (grams >> np.uint64(32)) | np.uint64(1)
        most = np.uint64(len(self.cells) - 1)
        return [((grams + np.uint64(k) * step) ^ (grams >> np.uint64(17))) & most for k in range(HASHES)]

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """One row of language bits per n-gram."""
        first, *rest = self.positions(grams)
        found = self.cells[first]
        for place in rest:
            found &= self.cells[place]
        return found

    def false_positives(self) -> np.ndarray:
        fill = [((self.cells[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))]
        return np.array(fill) ** HASHES


def build(languages: list[str], grams: np.ndarray, owners: np.ndarray) -> Filters:
    """Filters of (n-gram hash, index of a language whose filter contains it)."""
    size = 1 << max(10, int(np.ceil(np.log2(max(1, len(set(grams.tolist())) * CELLS_PER_GRAM)))))
    filters = Filters(languages, np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64))
    for place in filters.positions(grams):
        np.bitwise_or.at(filters.cells, (place, owners // 64), np.uint64(1) << (owners % 64).astype(np.uint64))
    return filters


def predict(filters: Filters, rates: np.ndarray, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    codes, owner, with_letter = codes_of(texts)
    hits = np.zeros((len(texts), max(1, len(filters.languages))))
    sizes = np.zeros(len(texts))
    for size in SIZES:
        grams, of = grams_of(codes, owner, size)
        masks = filters.masks(grams)
        sizes += np.bincount(of, minlength=len(texts))
        for i in range(len(filters.languages)):
            bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits[:, i] += np.bincount(of, weights=bit, minlength=len(texts))
    if not filters.languages:
        return [UNDECIDED] * len(texts), np.zeros(len(texts))
    corrected = np.maximum((hits - sizes[:, None] * rates) / (1 - rates), 0)
    best = corrected.argmax(axis=1)
    ordered = np.sort(np.pad(corrected, ((0, 0), (1, 0))), axis=1)
    top, second = ordered[:, -1], ordered[:, -2]
    # The languages come in the order of their training texts, so without a known n-gram the first one is best.
    score = np.where(top > 0, top / np.maximum(top + second, 1e-12), filters.share)
    return [filters.languages[i] if ok else UNDECIDED for i, ok in zip(best, with_letter)], np.where(with_letter, score, 0.0)


def fit(docs: DataFrame, training: Column) -> Filters:
    """Filters from the bounded sample of the rows where ``training`` holds."""
    labelled = docs.where(training & F.col("lang").isNotNull())
    # One row per language, as the filters have one bit for each.
    languages = sorted(((r["lang"], r["count"]) for r in labelled.groupBy("lang").count().collect()), key=lambda r: (-r[1], r[0]))
    if not languages:
        return build([], np.zeros(0, np.uint64), np.zeros(0, np.int64))
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = docs.sparkSession.createDataFrame(
        [(lang, i, min(1.0, ROWS / n)) for i, (lang, n) in enumerate(languages)], "lang string, language int, share double"
    )
    sample = (
        labelled.select("lang", "text", picked.alias("picked"))
        .join(F.broadcast(known), "lang")  # one row per language
        .where(F.col("picked") < F.col("share"))
    )

    def count(batches):
        schema = pa.schema([("language", pa.int32()), ("gram", pa.int64()), ("texts", pa.int64())])
        for batch in blocks(batches):
            own = batch.column("language").to_numpy()
            codes, owner, _ = codes_of(batch.column("text").to_pylist())
            for size in SIZES:
                grams, of = grams_of(codes, owner, size)
                pairs = np.unique(np.stack([of.astype(np.uint64), grams], 1), axis=0)
                once, texts = np.unique(
                    np.stack([own[pairs[:, 0].astype(np.int64)].astype(np.uint64), pairs[:, 1]], 1), axis=0, return_counts=True
                )
                yield record_batch(schema, [once[:, 0].astype(np.int32), once[:, 1].view(np.int64) if len(once) else [], texts])

    sizes = sample.groupBy("language").agg(F.count(F.lit(1)).alias("rows"))
    grams = sample.select("language", "text").mapInArrow(count, "language int, gram long, texts long")
    kept = (
        grams.groupBy("language", "gram")
        .agg(F.sum("texts").alias("texts"))
        .join(F.broadcast(sizes), "language")
        .where(F.col("texts") >= F.greatest(F.lit(1.0), F.lit(SHARE) * F.col("rows")))
        .select("language", "gram")
        .toArrow()
    )
    found = kept.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    filters = build([lang for lang, _ in languages], found, kept.column("language").to_numpy().astype(np.int64))
    filters.share = languages[0][1] / sum(n for _, n in languages)
    return filters


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """Columns doc_id, lang_pred and score for every row."""
    rates = filters.false_positives()

    def run(batches):
        for batch in blocks(batches, 1 << 19):
            lang, score = predict(filters, rates, batch.column("text").to_pylist())
            schema = pa.schema([("doc_id", batch.column("doc_id").type), ("lang_pred", pa.string()), ("score", pa.float64())])
            yield record_batch(schema, [batch.column("doc_id"), lang, score])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, lang_pred string, score double")
