"""Byte-level convolutional network for text quality, in numpy.

A document's UTF-8 bytes are covered by overlapping chunks. Learned filters slide over every byte of a
chunk; a chunk keeps each filter's largest response. Mean, largest and smallest of these over all
chunks of the document, with the text's size, go through one logistic layer, which gives one probability. The first layer is a sum of
table rows, one table per position in a filter, so a chunk costs a few array operations.

Training is bounded by ``TRAIN_ROWS`` labelled documents, of which it reads every chunk. Scoring reads every byte too.

Defined results: null text is empty text; it and texts shorter than a filter are padded with zero bytes, so
every row gets a score. Repeated rows are scored repeatedly. An empty table gives no rows. Without any
labelled training row the score is 0.5; with one class only, the network learns that class's share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataledger.llm.common import blocks, record_batch, utf8
from strataledger.llm.samples import labelled_sample

CHUNK = 512
WIDTH = 6
FILTERS = 16
TRAIN_ROWS = 3000
# Chunks at a time, so that their responses stay in the processor's cache.
TOGETHER = 96
STEPS = 560  # of 64 documents each, however few there are
THRESHOLD = 0.3
SIZES = 4
FEATURES = 3 * FILTERS + SIZES
STEP = CHUNK - WIDTH + 1  # windows of a chunk; the next chunk repeats the last WIDTH - 1 bytes


@dataclass
class Network:
    tables: np.ndarray  # (WIDTH, 256, FILTERS): a filter's weight for each byte at each position
    offset: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (FEATURES,)
    bias: float


def chunk_starts(size: int) -> list[int]:
    """Chunks that cover all bytes; the last one ends with the text."""
    if size <= CHUNK:
        return [0]
    return [*range(0, size - CHUNK, STEP), size - CHUNK]


def size_features(sizes) -> np.ndarray:
    """A short text gives filters few chances to respond, so the last layer is told its size. The first of
    these numbers also scales the responses: the less text, the nearer the result to the usual share."""
    sizes = np.maximum(np.asarray(sizes, np.float64), 1)[:, None]
    return np.hstack([np.minimum(sizes / bound, 1) for bound in (CHUNK // 2, CHUNK // 8, CHUNK // 32)] + [np.log(sizes) / 10])


def responses(net: Network, data: np.ndarray) -> np.ndarray:
    """Filter responses at every window of the bytes ``data``."""
    windows = len(data) - WIDTH + 1
    total = net.tables[0][data[:windows]]
    for place in range(1, WIDTH):
        total += net.tables[place][data[place : place + windows]]
    return total


def pooled_documents(net: Network, texts: list[bytes]) -> np.ndarray:
    """One row of features per text."""
    starts, ends, firsts, parts, at = [], [], [], [], 0
    for text in texts:
        firsts.append(len(starts))
        size = max(len(text), WIDTH)
        for start in chunk_starts(size):
            starts.append(at + start)
            ends.append(at + min(start + CHUNK, size) - WIDTH + 1)
        parts.append(text.ljust(size + 1, b"\0"))
        at += size + 1
    data = np.frombuffer(b"".join(parts) + b"\0" * WIDTH, np.uint8)
    pooled = np.empty((len(starts), FILTERS), np.float32)
    starts, ends = np.array(starts), np.array(ends)
    for low in range(0, len(starts), TOGETHER):
        own, stop = slice(low, low + TOGETHER), ends[low : low + TOGETHER].max()
        base = starts[low]
        found = responses(net, data[base : stop + WIDTH])
        edges = np.stack([starts[own] - base, ends[own] - base], 1).ravel()
        pooled[own] = np.maximum.reduceat(found, edges, axis=0)[::2]
    pooled = np.maximum(pooled + net.offset, 0)
    chunks = np.diff([*firsts, len(starts)])[:, None]
    mean = np.add.reduceat(pooled, firsts, axis=0) / chunks
    large, small = (f.reduceat(pooled, firsts, axis=0) for f in (np.maximum, np.minimum))
    sized = size_features([len(t) for t in texts])
    return np.hstack([np.hstack([mean, large, small]) * sized[:, :1], sized])


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    activation = pooled_documents(net, texts).astype(np.float64) @ net.weights + net.bias
    return 1 / (1 + np.exp(-np.clip(activation, -40, 40)))


def train(chunks: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, seed: int = 7) -> Network:
    """Adam on the logistic loss; ``chunks`` holds an array (n, CHUNK) of bytes per document, ``sizes``
    the whole documents' sizes."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, FEATURES),
        0.0,
    )
    if not len(labels):
        net.weights[:] = 0
        return net
    share = np.clip(labels.mean(), 0.01, 0.99)
    net.bias = float(np.log(share / (1 - share)))
    sized = size_features(sizes)
    moments = {name: [0.0, 0.0] for name in ("tables", "offset", "weights", "bias")}
    step = 0
    while step < STEPS:
        order = rng.permutation(len(labels))
        for low in range(0, len(order), 64):
            own = order[low : low + 64]
            data = np.concatenate([chunks[i] for i in own])
            counts = np.array([len(chunks[i]) for i in own])
            firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            best = np.empty((len(data), FILTERS), np.int64)
            raw = np.empty((len(data), FILTERS), np.float32)
            for at in range(0, len(data), TOGETHER):
                part = data[at : at + TOGETHER]
                flat = responses(net, np.append(part.ravel(), np.zeros(WIDTH - 1, np.uint8)))
                windows = flat.reshape(len(part), CHUNK, FILTERS)[:, :STEP]
                best[at : at + TOGETHER] = windows.argmax(axis=1)
                raw[at : at + TOGETHER] = windows.max(axis=1) + net.offset
            pooled = np.maximum(raw, 0)
            large = np.maximum.reduceat(pooled, firsts, axis=0)
            small = np.minimum.reduceat(pooled, firsts, axis=0)
            mean = np.add.reduceat(pooled, firsts, axis=0) / counts[:, None]
            scale = sized[own, :1]
            features = np.hstack([np.hstack([mean, large, small]) * scale, sized[own]])
            guess = 1 / (1 + np.exp(-np.clip(features @ net.weights + net.bias, -40, 40)))
            error = (guess - labels[own]) / len(own)
            to_features = np.outer(error, net.weights)
            by_mean, by_large, by_small = np.split(to_features[:, : 3 * FILTERS] * scale, 3, axis=1)
            each = np.repeat(np.arange(len(own)), counts)
            flow = (by_mean / counts[:, None])[each]
            flow += by_large[each] * (pooled == large[each]) + by_small[each] * (pooled == small[each])
            flow *= raw > 0
            tables = np.zeros_like(net.tables)
            rows = np.arange(len(data))[:, None]
            filters = np.broadcast_to(np.arange(FILTERS), best.shape)
            for place in range(WIDTH):
                np.add.at(tables[place], (data[rows, best + place], filters), flow)
            gradients = {
                "tables": tables,
                "offset": flow.sum(0),
                "weights": features.T @ error + 1e-4 * net.weights,
                "bias": error.sum(),
            }
            step += 1
            rate = 0.02 * max(0.0, 1 - step / STEPS) + 0.002
            for name, gradient in gradients.items():
                first, second = moments[name]
                first = 0.9 * first + 0.1 * gradient
                second = 0.999 * second + 0.001 * gradient**2
                moments[name] = [first, second]
                change = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
                value = getattr(net, name) - change
                setattr(net, name, value.astype(np.float32) if name in ("tables", "offset") else value)
    return net


def training_chunks(sample: DataFrame) -> DataFrame:
    """Columns doc_id, label, size and chunks: all chunks of each document, one after the other."""

    def cut(batches):
        for batch in blocks(batches):
            held, sizes = [], []
            for text in utf8(batch.column("text")):
                starts = chunk_starts(max(len(text), WIDTH))
                sizes.append(len(text))
                held.append(b"".join(text[s : s + CHUNK].ljust(CHUNK, b"\0") for s in starts))
            doc_ids = batch.column("doc_id")
            schema = pa.schema([("doc_id", doc_ids.type), ("label", pa.int32()), ("size", pa.int64()), ("chunks", pa.binary())])
            yield record_batch(schema, [doc_ids, batch.column("label"), sizes, held])

    doc_type = sample.schema["doc_id"].dataType.simpleString()
    return sample.select("doc_id", "label", "text").mapInArrow(
        cut, f"doc_id {doc_type}, label int, size long, chunks binary"
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network:
    """Train on the bounded sample: at most TRAIN_ROWS texts come to the driver."""
    rows = training_chunks(labelled_sample(docs, labels, label, TRAIN_ROWS)).toArrow().sort_by("doc_id")
    chunks = [np.frombuffer(c.as_py(), np.uint8).reshape(-1, CHUNK) for c in rows.column("chunks")]
    return train(chunks, rows.column("size").to_numpy(), rows.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, net: Network, column: str = "score") -> DataFrame:
    """Columns doc_id and ``column``, the probability of label 1, for every row."""

    def run(batches):
        for batch in blocks(batches):
            schema = pa.schema([("doc_id", batch.column("doc_id").type), (column, pa.float64())])
            yield record_batch(schema, [batch.column("doc_id"), probabilities(net, utf8(batch.column("text")))])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, {column} double")


def accepted(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all columns, whose probability reaches the threshold."""

    def run(batches):
        for batch in blocks(batches):
            keep = probabilities(net, utf8(batch.column("text"))) >= threshold
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
