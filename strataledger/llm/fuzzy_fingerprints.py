"""SimHash near-duplicates: fingerprints of 64 bits, linked at 2 or fewer differing bits through Golay-code keys.

A fingerprint is cut into three segments. Two errors leave at least one segment without error, and the two best
segments have one error at most between them. So a pair of segments is looked up as two codeword indices:
the prober takes the nearest codeword of both; the other side stands under its nearest codeword of one segment and
all codewords within 4 bits of the other one (1 or 6 of them). A codeword nearest to one word is within 3 bits of it,
hence within 4 bits of any word one bit away: no link can be missed. Candidates are verified on all 64 bits.

Keys that very many fingerprints probe are split by the third segment: it has two errors at most, so
the other side stands under all codewords within 5 bits. Equal fingerprints are one node from the start. A
fingerprint has at most 2080 others within 2 bits, which bounds the links per node.

Defined results: null, empty and white-space texts have fingerprint zero, linked like any other. With fewer
words than a shingle the whole sequence is one shingle. Rows that repeat an id get a row each. A
component is named by its smallest id; rows without an id belong to it, and a component of only such rows has
none. An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataledger.llm import golay
from strataledger.llm.common import blocks, record_batch, small_side, stored, utf8
from strataledger.llm.components import components

WORDS = 3
SEED = 42
BITS = 2
# Lowest bit and length of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# The segments of a key, and the one that it leaves out.
PAIRS = ((0, 1, 2), (0, 2, 1), (1, 2, 0))
# Probes of one key beyond which the third segment joins it.
HOT_PROBES = 256
# Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: bytes) -> int:
    """Bits that are set in over half the hashes of the text's shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - WORDS + 1)
    last = ends[len(words) - n :]
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, COUNTED):
        places = zip(starts[at : min(at + COUNTED, n)].tolist(), last[at : at + COUNTED].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in places], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Columns doc_id and fp, the fingerprint as a signed number, for every row."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
        for batch in blocks(batches):
            found = np.array([fingerprint(text) for text in utf8(batch.column("text"))], dtype=np.uint64)
            yield record_batch(schema, [batch.column("doc_id"), found.view(np.int64)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def segments(fps: np.ndarray) -> list[np.ndarray]:
    """The segments, as words of the code whose upper bits are zero."""
    return [((fps >> np.uint64(low)) & np.uint64((1 << size) - 1)).astype(np.int64) for low, size in SEGMENTS]


def key(pair: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (pair << 24) | (one << 12) | two


def probe_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, key and third index of the keys under which a fingerprint looks for others."""
    closest = [golay.nearest(words) for words in segments(fps)]
    rows = np.arange(len(fps))
    found = [(rows, key(p, closest[a], closest[b]), closest[c]) for p, (a, b, c) in enumerate(PAIRS)]
    return tuple(np.concatenate(columns) for columns in zip(*found))


def shelf_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and key of the places at which a fingerprint can be found."""
    words = segments(fps)
    closest = [golay.nearest(w) for w in words]
    around = [golay.near(w, 4) for w in words]
    rows, keys = [], []
    for p, (a, b, _) in enumerate(PAIRS):
        row, index = around[b]
        rows.append(row)
        keys.append(key(p, closest[a][row], index))
        row, index = around[a]
        other = index != closest[a][row]  # the nearest codewords of both segments are there already
        rows.append(row[other])
        keys.append(key(p, index[other], closest[b][row[other]]))
    return np.concatenate(rows), np.concatenate(keys)


def third_keys(fps: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and third index of the places, given the keys of two segments."""
    words = segments(fps)
    left_out = np.array([c for _, _, c in PAIRS])[keys >> 24]
    rows, indices = [], []
    for c, word in enumerate(words):
        chosen = np.flatnonzero(left_out == c)
        row, index = golay.near(word[chosen], 3 + BITS)
        rows.append(chosen[row])
        indices.append(index)
    return np.concatenate(rows), np.concatenate(indices)


def _mapped(rows: DataFrame, make, names: str) -> DataFrame:
    """Rows that ``make`` derives from blocks of fingerprints and their keys."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                columns = make(*[column.to_numpy(zero_copy_only=False) for column in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.replace(" long", "").split(", "))

    return rows.mapInArrow(run, names)


def links(nodes: DataFrame, hot_probes: int = HOT_PROBES) -> DataFrame:
    """All pairs (a, b), a below b, of different fingerprints ``fp`` with at most ``BITS`` differing bits."""

    def probing(fps):
        rows, keys, third = probe_keys(fps.view(np.uint64))
        return keys, third, fps[rows]

    def shelved(fps):
        rows, keys = shelf_keys(fps.view(np.uint64))
        return keys, fps[rows]

    def split(keys, fps):
        rows, third = third_keys(fps.view(np.uint64), keys)
        return keys[rows], third, fps[rows]

    probes = stored(_mapped(nodes.select("fp"), probing, "key long, third long, a long"), "probes")
    shelves = stored(_mapped(nodes.select("fp"), shelved, "key long, b long"), "shelves")
    hot = stored(probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_probes).select("key"), "hot_keys")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
    ordered = F.col("a") < F.col("b")
    if hot.isEmpty():
        found = probes.join(shelves, "key").where(near & ordered).select("a", "b")
        return found.distinct()
    few = small_side(hot)
    cold = probes.join(few, "key", "left_anti").join(shelves, "key")
    refined = stored(_mapped(shelves.join(few, "key", "left_semi").select("key", "b"), split, "key long, third long, b long"), "split")
    split_up = probes.join(few, "key", "left_semi").join(refined, ["key", "third"])
    return cold.where(near & ordered).select("a", "b").union(split_up.where(near & ordered).select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, hot_probes: int = HOT_PROBES) -> DataFrame:
    """Columns doc_id, fingerprint (16 hex digits) and component_id (smallest id that links reach), for every row."""
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    joined = components(links(nodes, hot_probes)).select(F.col("node").alias("fp"), "component")
    linked = stored(nodes.join(joined, "fp"), "linked")
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(smallest, "component").select("fp", "component_id")
    whole = nodes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(whole, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
