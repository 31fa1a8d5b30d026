"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction. A cluster's centroid and its widest member angle bound the inner product of
any member with any candidate: both lengths times the cosine of the candidate's angle to the centroid less that width
(angular upper bound). So the candidates of a block are sorted once per cluster by that bound, and every member
walks down the list until the bound of the next candidate certifies that nothing further can enter its result.

A request asks an anchor's best rows between a floor and a ceiling of the score, of its own label or of other ones.
Three searches use it: anchors against one block of their own cell (whose fifth score becomes a floor), anchors
against all blocks for the positives, and one request per positive for its negatives.

Candidates are dealt into blocks of cells, hot cells by hash; anchors into folios of clusters in the same way.
A block and a folio meet in a cogroup, unless the bounds of all their cells and clusters lie below the floors. Both sizes
are parameters, so a group is bounded however large a label, a cell or a group of copies is. Centroids are fitted on
at most ``FIT_ROWS`` rows; they only decide what is compared when, never what is found: results are exact.

Defined results: a row takes part if its label is not null and its vector is neither null nor holds a null, a
non-finite number or one beyond a long integer after scaling. Vectors of different lengths are filled up with
zeros; an empty vector scores zero. Every row counts for itself, also when it repeats an id; rows with an anchor's
id are never its positives or negatives. Rows without an id are no anchors and come first among ties.
Scores are exact up to 64 bits. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataledger.llm.common import record_batch, stored

SCALE = 256
FIT_ROWS = 8192
CELLS = 32
FIT_ROUNDS = 6
# Numbers that a block or a folio holds, 32 MB as doubles; with 64 components these are 65,536 rows.
BLOCK_NUMBERS = 1 << 22
POSITIVES = 5
NEGATIVES = 5
# A negative's score is at least this percentage of the positive's.
PERCENT = 80
LOWEST = -(1 << 62)
HIGHEST = 1 << 62
# Stands for a missing id inside.
NO_ID = -(1 << 63)
# Scores that are compared at once.
COMPARED = 1 << 22
EXACT = 1 << 53


def participating(rows: DataFrame, label: Column) -> DataFrame:
    """Columns vec_id, label and vector (scaled integers) of the rows that take part."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * F.when(fits(x), x.cast("double"))))
    kept = F.col("label").isNotNull() & F.forall("embedding", lambda x: F.coalesce(fits(x), F.lit(False)))
    return rows.where(kept).select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), scaled.alias("vector"))


def fits(x: Column) -> Column:
    # Not a number compares as greater than all numbers.
    return F.abs(x.cast("double")) < F.lit(float(1 << 54))


def matrix(column) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    made = np.zeros((len(column), int(lengths.max(initial=0))), np.int64)
    if made.size:
        made[np.arange(made.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return made


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows[:, :width]


def directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero vectors stay zero) and their lengths."""
    rows = rows.astype(np.float64)
    lengths = np.linalg.norm(rows, axis=1)
    return rows / np.where(lengths > 0, lengths, 1)[:, None], lengths


def fit_centroids(sample: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Directions of at most ``cells`` clusters of the sample."""
    units, _ = directions(sample)
    rng = np.random.default_rng(11)
    centroids = units[rng.permutation(len(units))[:cells]]
    for _ in range(FIT_ROUNDS):
        nearest = (units @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, units)
        filled = np.linalg.norm(sums, axis=1) > 0
        centroids = np.where(filled[:, None], directions(sums)[0], centroids)
    return centroids


def placed(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cell (the nearest centroid), angle (to it) and length."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]):
        schema = pa.schema(
            [("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.int64()))]
            + [("cell", pa.int64()), ("angle", pa.float64()), ("length", pa.float64())]
        )
        for batch in batches:
            vectors = matrix(batch.column("vector"))
            # Components beyond the centroids' width only shorten the cosine, and the angle stays the true one.
            whole = max(width, vectors.shape[1])
            units, lengths = directions(widened(vectors, whole))
            cosines = units @ widened(centroids, whole).T
            cells = cosines.argmax(axis=1)
            angles = np.arccos(np.clip(cosines[np.arange(len(cells)), cells], -1, 1))
            yield record_batch(schema, [*batch.columns, cells, angles, lengths])

    return rows.mapInArrow(run, "vec_id long, label long, vector array<bigint>, cell long, angle double, length double")


def dealing(counts: dict[int, int], size: int) -> list[tuple[int, int, int]]:
    """Cell, first group and number of groups: small cells share a group, large ones are cut."""
    found, group, room = [], -1, 0
    for cell, count in sorted(counts.items()):
        if count > size:
            parts = -(-count // size)
            found.append((cell, group + 1, parts))
            group, room = group + parts, 0
        else:
            if count > room:
                group, room = group + 1, size
            found.append((cell, group, 1))
            room -= count
    return found


def dealt(rows: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """``rows`` with their group; the rows of a cut cell are spread by their key."""
    spread = F.col("first") + F.pmod(F.xxhash64("key"), F.col("parts"))
    return rows.join(F.broadcast(groups), "cell").withColumn(name, spread).drop("first", "parts")


def upper_bounds(units: np.ndarray, lengths: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Highest inner product of each row with any of the members (of length one)."""
    centre = members.sum(axis=0)
    size = np.linalg.norm(centre)
    if size == 0:
        return lengths
    centre /= size
    width = np.arccos(np.clip(members @ centre, -1, 1)).max()
    angles = np.arccos(np.clip(units @ centre, -1, 1)) - width
    return lengths * np.cos(np.clip(angles, 0, np.pi))


class Best:
    """The best ``top`` rows of every request so far, by score, ties by id; floors rise as requests fill up."""

    def __init__(self, floors: np.ndarray, top: int):
        self.top, self.floors = top, floors.copy()
        self.last_ids = np.full(len(floors), np.iinfo(np.int64).max)
        self.rows = [np.zeros(0, np.int64) for _ in range(3)]  # request, score, id

    def add(self, requests, scores, ids):
        columns = [np.concatenate(pair) for pair in zip(self.rows, (requests, scores, ids))]
        order = np.lexsort((columns[2], -columns[1], columns[0]))
        columns = [column[order] for column in columns]
        starts = np.flatnonzero(np.diff(columns[0], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
        self.rows = [column[rank < self.top] for column in columns]
        full = rank == self.top - 1
        self.floors[columns[0][full]] = columns[1][full]
        self.last_ids[columns[0][full]] = columns[2][full]


def walk(block: dict, members: dict, same_label: bool, top: int) -> Best:
    """Results of one cluster's requests in one block.

    ``block``: ids, labels, vectors. ``members``: ids, labels, vectors of the anchors; owner (anchor number),
    floors and ceilings of the requests.
    """
    width = max(block["vectors"].shape[1], members["vectors"].shape[1], 1)
    vectors, anchors = widened(block["vectors"], width), widened(members["vectors"], width)
    units, lengths = directions(vectors)
    member_units, member_lengths = directions(anchors)
    bounds = upper_bounds(units, lengths, member_units)
    order = np.lexsort((block["ids"], -bounds))
    largest = int(np.abs(vectors).max(initial=0)) * int(np.abs(anchors).max(initial=0))
    if width * largest < EXACT:  # then every partial sum is exact in doubles, which multiply much faster
        vectors, anchors = vectors.astype(np.float64), anchors.astype(np.float64)
    owner, ceilings = members["owner"], members["ceilings"]
    best = Best(members["floors"], top)
    active, at = np.arange(len(owner)), 0
    while at < len(order):
        # Room for rounding, so that a candidate on the bound is still seen.
        reach = member_lengths[owner[active]] * bounds[order[at]]
        active = active[reach + 1e-9 * np.abs(reach) + 1e-3 >= best.floors[active]]
        if not len(active):
            break
        step = min(4096, max(64, COMPARED // len(active)))
        listed = order[at : at + step]
        asking, which = np.unique(owner[active], return_inverse=True)
        scores = (anchors[asking] @ vectors[listed].T)[which]
        floors = best.floors[active][:, None]
        fits = (scores > floors) | ((scores == floors) & (block["ids"][listed] < best.last_ids[active][:, None]))
        fits &= scores <= ceilings[active][:, None]
        equal = members["labels"][owner[active]][:, None] == block["labels"][listed]
        fits &= equal if same_label else ~equal
        fits &= members["ids"][owner[active]][:, None] != block["ids"][listed]
        request, place = np.nonzero(fits)
        if len(request):
            best.add(active[request], scores[request, place].astype(np.int64), block["ids"][listed[place]])
        at += step
    return best


def needed_pairs(clusters: dict, cells: dict, centroids: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of cluster and cell whose members can reach the cluster's lowest floor."""
    between = np.arccos(np.clip(centroids @ centroids.T, -1, 1))
    found = []
    for cluster, (length, width, floor) in clusters.items():
        for cell, (cell_length, cell_width) in cells.items():
            cosine = np.cos(max(0.0, between[cluster, cell] - width - cell_width))
            highest = length * cell_length * cosine if cosine >= 0 else 0.0
            if highest * (1 + 1e-9) + 1e-3 >= floor:
                found.append((cluster, cell))
    return found


def searched(candidates: DataFrame, requests: DataFrame, same_label: bool, top: int) -> DataFrame:
    """Columns key, request, vec_id, score: the best rows of every request.

    ``candidates``: vec_id, label, vector, block, folio (one row per folio that the block meets). ``requests``:
    key, vec_id, label, vector, cell, floors, ceilings, folio, block (one row per block).
    """
    schema = pa.schema([("key", pa.int64()), ("request", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = [schema.empty_table()]
        if left.num_rows and right.num_rows:

            def numbers(table: pa.Table, name: str, null: int = 0) -> np.ndarray:
                return table.column(name).fill_null(null).to_numpy().astype(np.int64)

            # A missing id comes first among ties, and equals no anchor's.
            block = {"ids": numbers(left, "vec_id", NO_ID), "labels": numbers(left, "label"), "vectors": matrix(left.column("vector"))}
            for cluster in np.unique(numbers(right, "cell")):
                own = right.filter(pa.array(numbers(right, "cell") == cluster))
                floors, ceilings = matrix(own.column("floors")), matrix(own.column("ceilings"))
                counts = own.column("floors").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
                held = np.arange(floors.shape[1]) < counts[:, None]
                members = {"ids": numbers(own, "vec_id"), "labels": numbers(own, "label"), "vectors": matrix(own.column("vector"))}
                members |= {"owner": np.nonzero(held)[0], "floors": floors[held], "ceilings": ceilings[held]}
                number = np.nonzero(held)[1]
                request, score, ids = walk(block, members, same_label, top).rows
                columns = [numbers(own, "key")[members["owner"][request]], number[request], ids, score]
                tables.append(pa.Table.from_batches([record_batch(schema, columns)]))
        return pa.concat_tables(tables)

    left = candidates.select("vec_id", "label", "vector", "block", "folio").groupBy("folio", "block")
    right = requests.select("key", "vec_id", "label", "vector", "cell", "floors", "ceilings", "folio", "block").groupBy("folio", "block")
    found = left.cogroup(right).applyInArrow(meet, "key long, request long, vec_id long, score long")
    best = Window.partitionBy("key", "request").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


class Index:
    """Rows in cells and blocks, and the anchors among them in folios."""

    def __init__(self, rows: DataFrame, is_anchor: Column, cells: int = CELLS, block_numbers: int = BLOCK_NUMBERS):
        spark = rows.sparkSession
        rows = stored(rows, "vectors")
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("vector").toArrow()
        fitted = matrix(sample.column("vector"))
        self.centroids = fit_centroids(fitted if fitted.shape[1] else np.zeros((1, 1)), cells)
        self.rows = stored(placed(rows, self.centroids).withColumn("key", F.monotonically_increasing_id()), "placed")
        # One row per cell.
        stats = self.rows.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(is_anchor, 1)).alias("n_anchors"),
            F.max("length").alias("length"),
            F.max("angle").alias("width"),
            F.max(F.size("vector")).alias("numbers"),
        ).collect()
        size = max(1, block_numbers // max([1, *(r["numbers"] for r in stats)]))
        self.cells = {r["cell"]: (r["length"], r["width"]) for r in stats}
        self.blocks = spark.createDataFrame(dealing({r["cell"]: r["n"] for r in stats}, size), "cell long, first long, parts long")
        anchor_cells = {r["cell"]: r["n_anchors"] for r in stats if r["n_anchors"]}
        self.folios = spark.createDataFrame(dealing(anchor_cells, size), "cell long, first long, parts long")
        self.candidates = dealt(self.rows, self.blocks, "block")
        self.anchors = dealt(self.rows.where(is_anchor), self.folios, "folio")

    def search(self, asked: DataFrame, same_label: bool, top: int, home: bool = False) -> DataFrame:
        """``asked``: key, floors and ceilings per anchor. With ``home``, one block of the anchor's own cell only."""
        spark = asked.sparkSession
        requests = stored(self.anchors.join(asked, "key"), "requests")
        lowest = requests.groupBy("cell").agg(
            F.max("length").alias("length"), F.max("angle").alias("width"), F.min(F.array_min("floors")).alias("floor")
        )
        clusters = {r["cell"]: (r["length"], r["width"], r["floor"]) for r in lowest.collect()}
        pairs = [(c, c) for c in clusters] if home else needed_pairs(clusters, self.cells, self.centroids)
        pairs = F.broadcast(spark.createDataFrame(pairs, "cluster long, cell long"))  # at most the square of the number of cells
        blocks = F.sequence("first", F.col("first") if home else F.col("first") + F.col("parts") - 1)
        blocks = self.blocks.select("cell", F.explode(blocks).alias("block"))
        folios = self.folios.select(
            F.col("cell").alias("cluster"), F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("folio")
        )
        meetings = stored(folios.join(pairs, "cluster").join(blocks, "cell").select("folio", "block").distinct(), "meetings")
        spread = self.candidates.join(meetings, "block")
        return searched(spread, requests.join(meetings, "folio"), same_label, top)


def mined(rows: DataFrame, is_anchor: Column, cells: int = CELLS, block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """Columns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` as ``participating`` returns them; ``is_anchor`` chooses the anchors by the columns of ``rows``.
    """
    index = Index(rows, is_anchor, cells, block_numbers)

    def given(vec_id: str) -> Column:
        return F.when(F.col(vec_id) != NO_ID, F.col(vec_id))

    def one(value: Column, name: str) -> Column:
        return F.array(value.cast("long")).alias(name)

    anchors = index.anchors.select("key", F.col("vec_id").alias("anchor_id"))
    first = index.search(
        anchors.select("key", one(F.lit(LOWEST), "floors"), one(F.lit(HIGHEST), "ceilings")), True, POSITIVES, home=True
    )
    floor = stored(first.where(F.col("rank") == POSITIVES).select("key", "score"), "floors")
    floors = anchors.join(floor, "key", "left").select(
        "key", one(F.coalesce("score", F.lit(LOWEST)), "floors"), one(F.lit(HIGHEST), "ceilings")
    )
    positives = stored(index.search(floors, True, POSITIVES).select("key", "vec_id", "score", "rank"), "positives")
    # A positive with a negative score has no negatives: 80 % of it is above it.
    ranges = (
        positives.where("score >= 0")
        .groupBy("key", "score")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("positive_ids"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("score", "positive_ids"))).alias("wanted"))
    )
    ranges = stored(ranges, "ranges")  # at most one entry per positive
    asked = ranges.select(
        "key",
        F.transform("wanted", lambda w: F.ceil(w["score"] * F.lit(PERCENT) / F.lit(100)).cast("long")).alias("floors"),
        F.transform("wanted", lambda w: w["score"]).alias("ceilings"),
    )
    negatives = index.search(asked, False, NEGATIVES)
    return (
        negatives.join(ranges, "key")
        .join(anchors, "key")
        .withColumn("wanted", F.get("wanted", F.col("request").cast("int")))
        .withColumn("positive_id", F.explode("wanted.positive_ids"))
        .select(
            "anchor_id",
            given("positive_id").alias("positive_id"),
            "rank",
            given("vec_id").alias("negative_id"),
            F.col("wanted.score").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
