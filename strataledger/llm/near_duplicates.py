"""Near-duplicate documents: similarity sketches, banding, exact verification, components.

A document's set holds its distinct five-word shingles (64-bit hashes). Documents with equal sets are
one node from the start, so copies are never compared with each other. Nodes are numbered when they are
written; ids come back only after the components are known, as rows of one id may hold different texts. The
sketches of nodes are cut into bands; nodes that share a band are candidates. Threshold and bands are parameters:
with 24 bands of 6 rows a pair of 85 % shares a band with probability 0.99998, with 28 bands of 5 one of 80 % does.

Candidates are verified on full sets, in two passes that never list all pairs of a bucket:

1. Every bucket is compared with its centre only, the member with the fewest shingles that no other
   candidate has. Linked nodes form components.
2. In buckets that still hold several components, nodes of different components are compared, except where
   sizes and private shingles already bound their similarity below the threshold: a shingle found in one
   candidate alone cannot be shared. Pairs inside a component need no comparison.

Defined results: null, empty and white-space texts have an empty set, link with nothing, and are kept. A text
with fewer words than a shingle has one shingle, its whole sequence. Rows without an id
have no component and are kept. Rows that repeat an id each get a row and the component of their own text. Of
rows that repeat an id, ``deduplicated`` keeps one per group of equal or linked texts (texts without words count as
equal), and all that differ. An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.llm.common import blocks, record_batch, small_side, stored, utf8
from strataledger.llm.components import components
from strataledger.llm.shingles import U64, mix, shingle_sets
from strataledger.llm.similarity_sketch import BANDS, ROWS, band_keys, sketch

# A pair is linked if 100 * intersection >= percent * union. This is the percentage of op6's contract.
PERCENT = 85
# Text that is hashed at once: hashing takes about forty times its size.
BLOCK_BYTES = 1 << 19


def fingerprint(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    one = mix(elements ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    two = mix(elements + U64(0x1234567890ABCDEF)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def sketched(docs: DataFrame, bands: int = BANDS, height: int = ROWS) -> DataFrame:
    """Columns doc_id, n_shingles, f1, f2 (the set's name) and bands (empty for an empty set)."""

    def run(batches):
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64())]
            + [("bands", pa.list_(pa.int64()))]
        )
        for batch in blocks(batches, BLOCK_BYTES):
            sets = shingle_sets(utf8(batch.column("text")))
            names = [fingerprint(s) for s in sets]
            keys = [band_keys(sketch(s, bands * height), height).view(np.int64) if len(s) else [] for s in sets]
            columns = [[len(s) for s in sets], [one for one, _ in names], [two for _, two in names], keys]
            yield record_batch(schema, [batch.column("doc_id"), *columns])

    names = "doc_id long, n_shingles long, f1 long, f2 long, bands array<bigint>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, names)


def candidate_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Full sets of ``nodes`` (node, least, f1, f2), made again from the documents' texts."""
    wanted = nodes.select(F.col("least").alias("doc_id"), "node", "f1", "f2")
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(small_side(wanted), "doc_id")

    def run(batches):
        schema = pa.schema([("node", pa.int64()), ("elements", pa.list_(pa.int64()))])
        for batch in blocks(batches, BLOCK_BYTES):
            sets = shingle_sets(utf8(batch.column("text")))
            asked = zip(batch.column("f1").to_pylist(), batch.column("f2").to_pylist())
            # A row that shares the id but holds another text belongs to another node.
            fits = [fingerprint(s) == name for s, name in zip(sets, asked)]
            named = batch.column("node").filter(pa.array(fits, pa.bool_()))
            yield record_batch(schema, [named, [s.view(np.int64) for s, fit in zip(sets, fits) if fit]])

    made = texts.mapInArrow(run, "node long, elements array<bigint>")
    return made.groupBy("node").agg(F.first("elements").alias("elements"))  # equal rows give equal sets


def highest(n_a: Column, own_a: Column, n_b: Column, own_b: Column, percent: int) -> Column:
    """Whether sets of these sizes, with these numbers of private elements, can be linked."""
    common = F.least(n_a - own_a, n_b - own_b)
    return F.lit(100) * common >= F.lit(percent) * (n_a + n_b - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("elements").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("elements").alias("set_b"))
    joined = pairs.select("a", "b").join(two, "b").join(one, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return joined.where(F.lit(100) * common >= F.lit(percent) * union).select("a", "b")


def links(docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all similar nodes."""
    banded = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    members = stored(banded.join(shared, "bucket"), "members")
    candidates = nodes.join(members.select("node").distinct(), "node")
    sets = stored(candidate_sets(docs, candidates), "sets")
    elements = sets.select("node", F.explode("elements").alias("element"))
    private = (
        elements.groupBy("element")
        .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
        .where("n = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    sized = stored(
        sets.select("node", F.size("elements").cast("long").alias("n"))
        .join(private, "node", "left")
        .select("node", "n", F.coalesce("own", F.lit(0).cast("long")).alias("own")),
        "sizes",
    )
    placed = stored(members.join(sized, "node"), "placed")
    centres = placed.groupBy("bucket").agg(F.min(F.struct("own", "node", "n")).alias("centre"))
    star = (
        placed.join(centres, "bucket")
        .where((F.col("node") != F.col("centre.node")) & highest(F.col("n"), F.col("own"), F.col("centre.n"), F.col("centre.own"), percent))
        .select(F.col("centre.node").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    first = stored(verified(star, sets, percent), "links")
    grouped = components(first)
    labelled = placed.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low != high").select("bucket")
    open_ = stored(labelled.join(mixed, "bucket").join(nodes.select("node", "bands"), "node"), "open")
    # Keys name their band, so earlier bands that a pair shares are equal keys before this one.
    earlier = F.slice("bands", 1, F.col("band")).alias("earlier")
    left, right = (
        open_.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "own", "component")], earlier.alias(f"earlier_{side}"))
        for side in ("a", "b")
    )
    rest = (
        left.join(right, "bucket")
        .where("node_a < node_b and component_a != component_b")
        .where(highest(F.col("n_a"), F.col("own_a"), F.col("n_b"), F.col("own_b"), percent))
        .where(~F.arrays_overlap("earlier_a", "earlier_b"))
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    )
    return first.union(stored(verified(rest, sets, percent), "links"))


SET = ("n_shingles", "f1", "f2")


def grouped(docs: DataFrame, percent: int, bands: int, height: int) -> DataFrame:
    """Columns doc_id, the set's name, component (a number; null for empty sets) and component_id for every row."""
    rows = stored(sketched(docs, bands, height), "sketches")
    nodes = rows.where("n_shingles > 0 and doc_id is not null").groupBy(*SET)
    nodes = nodes.agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"))  # equal sets have equal bands
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    linked = components(links(docs, nodes, percent))
    # Only nodes with links need a component and its smallest id.
    linked = stored(nodes.select("node", "least").join(linked, "node"), "linked")
    smallest = linked.groupBy("component").agg(F.min("least").alias("smallest"))
    placed = linked.join(smallest, "component").select("node", "component", "smallest")
    named = nodes.join(placed, "node", "left").select(
        *SET, F.coalesce("component", "node").alias("component"), F.coalesce("smallest", "least").alias("smallest")
    )
    return rows.select("doc_id", *SET).join(named, list(SET), "left").select(
        "doc_id",
        *SET,
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, height: int = ROWS) -> DataFrame:
    """Columns doc_id, n_shingles, component_id (smallest id that links reach) and kept, for every row.

    Pairs of at least ``percent`` are linked; candidates share one of ``bands`` bands of ``height`` rows.
    """
    return grouped(docs, percent, bands, height).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def with_set_names(docs: DataFrame) -> DataFrame:
    """Columns row (all columns of ``docs``), doc_id and the name of the row's set."""
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long"), "text")

    def run(batches):
        for batch in blocks(batches, BLOCK_BYTES):
            sets = shingle_sets(utf8(batch.column("text")))
            names = [fingerprint(s) for s in sets]
            columns = [[len(s) for s in sets], [one for one, _ in names], [two for _, two in names]]
            arrays = [batch.column("row"), batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", *SET])

    kind = whole.schema["row"].dataType.simpleString()
    return whole.mapInArrow(run, f"row {kind}, doc_id long, n_shingles long, f1 long, f2 long")


def deduplicated(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, height: int = ROWS) -> DataFrame:
    """One document of each component, with all columns; rows without an id all stay."""
    found = stored(grouped(docs, percent, bands, height), "near_duplicates").where("doc_id is not null")
    repeated = stored(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    dropped = found.where("component_id != doc_id").select("doc_id")
    if repeated.isEmpty():
        return docs.join(small_side(stored(dropped, "dropped")), "doc_id", "left_anti").select(*docs.columns)
    # An id with several rows does not tell which of them goes: these rows are named by their sets again.
    ids = small_side(repeated)
    dropped = small_side(stored(dropped.join(ids, "doc_id", "left_anti"), "dropped"))
    once = docs.join(ids, "doc_id", "left_anti").join(dropped, "doc_id", "left_anti").select(*docs.columns)
    chosen = (
        found.join(ids, "doc_id", "left_semi")
        .where("component_id = doc_id")
        .groupBy("doc_id", "component")
        .agg(F.min(F.struct(*SET)).alias("set"))
        .select("doc_id", "set.*")
    )
    again = with_set_names(docs.join(ids, "doc_id", "left_semi").select(*docs.columns))
    kept = again.join(chosen, ["doc_id", *SET]).dropDuplicates(["doc_id", *SET])
    return once.union(kept.select("row.*"))
