"""Harmonic packing of token sequences.

Piece lengths fall into reciprocal-capacity classes: a sequence of capacity ``C`` that takes pieces of
length ``L`` always takes ``C // L`` of them. Which sequence a piece belongs to then follows from its
rank in its class alone, so every task numbers its own pieces and no task looks at another one's.

Documents may be cut, which is used to avoid padding: whole sequences are cut off first, and the rest
is cut at the class bounds ``C // 2, C // 3, ...`` from the longest one that fits, down to a last piece of
at most ``C // 32`` tokens that stays whole. Per class only the sequence that is not full is left over;
those pieces are fewer than the sum of ``C // L`` over the classes, a bound that ``C`` alone sets, and their
classes are merged by first-fit decreasing.

Defined results: null text is empty text and gives one piece with the end id. Repeated rows are packed
repeatedly, also with equal or null ids. An empty table gives no pieces. Only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataledger.llm.common import blocks, record_batch, stored
from strataledger.sources.files import local_frame
from pyspark.sql.types import LongType, StructField, StructType

CAPACITY = 2048
END_ID = 1
# The tokenizer's file, and its vocabulary as ranks: these give the same ids several times faster.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=4)
def encoder(tokenizer: str, ranks: str) -> Callable[[str], np.ndarray]:
    """Token ids of a text, as the tokenizer's file has them: its added tokens are recognised in the text."""
    with open(tokenizer, encoding="utf-8") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=added
    )
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())


@lru_cache(maxsize=4)
def tails(capacity: int) -> list[tuple[int, ...]]:
    """How a rest of ``n`` tokens is cut, for every ``n`` below the capacity."""
    bounds = sorted({capacity // j for j in range(1, min(32, capacity) + 1)})
    smallest = capacity // 32
    cuts: list[tuple[int, ...]] = [()]
    for n in range(1, capacity):
        if n <= smallest:
            cuts.append((n,))
        else:
            longest = max(b for b in bounds if b <= n)
            cuts.append((longest, *cuts[n - longest]))
    return cuts


def pieces_of(n: int, capacity: int) -> list[int]:
    return [capacity] * (n // capacity) + list(tails(capacity)[n % capacity])


def merged(left: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """First-fit decreasing of ``(length, count)``: rows of length, place among the class's rest, sequence, offset."""
    filled: list[int] = []
    placed = []
    for length, count in sorted(left, reverse=True):
        at = 0
        for place in range(count):
            while at < len(filled) and filled[at] + length > capacity:
                at += 1
            if at == len(filled):
                filled.append(0)
            placed.append((length, place, at, filled[at]))
            filled[at] += length
    return placed


def tokenized_pieces(docs: DataFrame, capacity: int, tokenizer: str, ranks: str, end_id: int) -> DataFrame:
    """One row per piece with its ids, the task that made it, and its number in the task's class."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    names = "start long, length long, ids binary, doc_tokens long, part int, slot long"
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        encode = encoder(tokenizer, ranks)
        part = TaskContext.get().partitionId()
        used: dict[int, int] = {}
        for batch in blocks(batches):
            rows, starts, lengths, ids, totals, slots = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                encoded = encode(text or "").astype("<u4", copy=False).tobytes() + end
                total, start = len(encoded) // 4, 0
                for length in pieces_of(total, capacity):
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    ids.append(encoded[4 * start : 4 * (start + length)])
                    totals.append(total)
                    slots.append(used.get(length, 0))
                    used[length] = slots[-1] + 1
                    start += length
            doc_ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            schema = pa.schema(
                [("doc_id", doc_ids.type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
                + [("doc_tokens", pa.int64()), ("part", pa.int32()), ("slot", pa.int64())]
            )
            yield record_batch(schema, [doc_ids, starts, lengths, ids, totals, [part] * len(rows), slots])

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {doc_type}, {names}")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, ranks: str = RANKS, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents with their token ids, sequence and offset in the sequence.

    Columns: doc_id, start, length, ids (little-endian 32-bit integers), doc_tokens, sequence_id, offset.
    """
    spark = docs.sparkSession
    pieces = stored(tokenized_pieces(docs, capacity, tokenizer, ranks, end_id), "pieces")
    # One row per task and class; at most 32 + capacity // 32 classes.
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy("length").orderBy("part")
    bases = counts.select(
        "part",
        "length",
        (F.sum("n").over(by_class) - F.col("n")).alias("base"),
        F.sum("n").over(Window.partitionBy("length")).alias("class_pieces"),
    )
    bases = stored(bases, "bases")
    per_sequence = F.floor(F.lit(capacity) / F.col("length"))
    in_full = per_sequence * F.floor(F.col("class_pieces") / per_sequence)
    # At most one row per class.
    left = bases.select("length", (F.col("class_pieces") - in_full).alias("rest")).distinct().collect()
    schema = StructType([StructField(c, LongType()) for c in ("length", "place", "merged_into", "merged_at")])
    rest = local_frame(spark, merged([(r["length"], r["rest"]) for r in left], capacity), schema)
    ranked = (
        pieces.join(bases, ["part", "length"])
        .withColumn("rank", F.col("base") + F.col("slot"))
        .withColumn("place", F.when(F.col("rank") >= in_full, F.col("rank") - in_full))
        .join(F.broadcast(rest), ["length", "place"], "left")  # the capacity bounds its rows
    )
    # Full sequences are named by class and number, merged ones by class 0.
    sequence = F.floor(F.col("rank") / per_sequence) * (capacity + 1) + F.col("length")
    return ranked.select(
        "doc_id",
        "start",
        "length",
        "ids",
        "doc_tokens",
        F.coalesce(F.col("merged_into") * (capacity + 1), sequence).cast("long").alias("sequence_id"),
        F.coalesce("merged_at", (F.col("rank") % per_sequence) * F.col("length")).cast("long").alias("offset"),
    )
