"""Merkle manifest of a dataset: one tree of eight-way digests per language and one over the languages.

A leaf is the digest of a row's fields. The leaves of a language ascend by id; at every level each run of eight
consecutive nodes becomes their digest, until one is left, the language's subroot. Subroots in byte order of
the language (null first) make the same kind of tree, which ends in the root. Digests are sha256 as lowercase hex.

Nodes are worked on in superblocks of ``8 ** DEPTH`` consecutive ones, each of which reduces to one outer node without
looking at another superblock. Outer nodes are grouped into superblocks again, so a round takes four levels, and
rounds shrink by 4096. On the way down, a cogroup hands every superblock the one outer row it needs: the
siblings of its own node up to the root. In that call the superblock's levels are made, its nodes' siblings joined
to the outer ones, and the proofs folded. A group is never larger than a superblock, however many rows a language has.

Positions come from one range sort of (language, id, leaf) and the counts per sorted partition.

Defined results: null fields count as ``-``; a null id sorts first, and as decimal text it is empty. Rows that repeat
an id are leaves beside each other, ordered by their digest; equal rows have equal leaves and a place each.
A language with one row has its leaf as subroot, with one language the subroot is the root. An empty table
has no rows. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataledger.llm.common import id_remainder, stored

FANOUT = 8
# Levels of a superblock, so that it has 4096 nodes.
DEPTH = 4

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NODES = "tree string, size long, position long, digest string"
PATHS = "tree string, position long, lefts array<string>, rights array<string>"
PROOFS = """doc_id long, tree string, position long, leaf string, subroot string, root string,
    lefts array<string>, rights array<string>, proof_sha256 string, folded_root string"""


def digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


def shrunk(size: int, levels: int) -> int:
    """Nodes that are left of ``size`` after so many levels."""
    for _ in range(levels):
        size = -(-size // FANOUT)
    return size


def local_height(size: int, depth: int) -> int:
    """Levels that a superblock reduces in a tree of ``size`` nodes."""
    height = 0
    while size > 1 and height < depth:
        size, height = shrunk(size, 1), height + 1
    return height


def local_levels(digests: list[str], height: int) -> list[list[str]]:
    """A superblock's nodes and the levels above them; the last level has one node."""
    levels = [digests]
    for _ in range(height):
        below = levels[-1]
        levels.append([digest("".join(below[at : at + FANOUT])) for at in range(0, len(below), FANOUT)])
    return levels


def siblings(levels: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """Digests left and right of node ``at`` in its run, and of the nodes above it, level by level."""
    lefts, rights = [], []
    for level in levels[:-1]:
        run = at - at % FANOUT
        lefts.append("".join(level[run:at]))
        rights.append("".join(level[at + 1 : run + FANOUT]))
        at //= FANOUT
    return lefts, rights


def folded(node: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights):
        node = digest(left + node + right)
    return node


def leaf(text: Column) -> Column:
    """Digest of a row's fields with ``text`` as its text."""

    def part(value: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    fields = [F.col(name).cast("string") for name in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*map(part, [*fields, text])).cast("binary"), 256)


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their position in ``tree`` by ``order`` and the tree's ``size``, without one task per tree."""
    ordered = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # The upper bits of this number are the sorted partition, the lower ones the row in it.
    placed = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    counts = placed.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    whole = Window.partitionBy("tree")  # one row per sorted partition that the tree reaches
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        counts.select(
            "part",
            "tree",
            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"),
            F.sum("n").over(whole).alias("size"),
        ),
        "bases",
    )
    position = (F.col("place") + F.col("base")).alias("position")
    return placed.join(bases, ["part", "tree"]).select(*rows.columns, "size", position)


def superblock(depth: int) -> Column:
    return F.expr(f"position div {FANOUT**depth}").alias("block")


def reduced(nodes: DataFrame, depth: int) -> DataFrame:
    """The outer nodes: one per superblock of ``nodes``."""

    def reduce(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        size = int(block["size"].iloc[0])
        height = local_height(size, depth)
        top = local_levels(list(block["digest"]), height)[-1][0]
        return pd.DataFrame([(key[0], shrunk(size, height), key[1], top)], columns=["tree", "size", "position", "digest"])

    return nodes.select("tree", "size", "position", "digest").groupBy("tree", superblock(depth)).applyInPandas(reduce, NODES)


def towers(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Stored tables of ``nodes`` and of the outer nodes of every round, up to one node per tree."""
    found = [nodes]
    size = nodes.agg(F.max("size")).first()[0] or 0
    while size > 1:
        size = shrunk(size, local_height(size, depth))
        found.append(stored(reduced(found[-1], depth), "outer_nodes"))
    return found


def descended(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """Siblings of every node up to the top, given those of the superblocks' own nodes."""

    def descend(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        levels = local_levels(list(block["digest"]), local_height(int(block["size"].iloc[0]), depth))
        lefts, rights = list(above["lefts"].iloc[0]), list(above["rights"].iloc[0])
        paths = [siblings(levels, at) for at in range(len(block))]
        return pd.DataFrame(
            {
                "tree": key[0],
                "position": block["position"],
                "lefts": [left + lefts for left, _ in paths],
                "rights": [right + rights for _, right in paths],
            }
        )

    blocks = nodes.select("tree", "size", "position", "digest").groupBy("tree", superblock(depth))
    asked = outer.select("tree", "position", "lefts", "rights").groupBy("tree", F.col("position").alias("block"))
    return blocks.cogroup(asked).applyInPandas(descend, PATHS)


def empty_path() -> list[Column]:
    return [F.array().cast("array<string>").alias(name) for name in ("lefts", "rights")]


def exchanged(leaves: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """Proof and folded root of every leaf: leaves (with ``now``, the digest to fold) meet their superblock's outer row."""

    def prove(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        levels = local_levels(list(block["digest"]), local_height(int(block["size"].iloc[0]), depth))
        lefts, rights = list(above["lefts"].iloc[0]), list(above["rights"].iloc[0])
        rows = []
        for at, now in enumerate(block["now"]):
            left, right = siblings(levels, at)
            left, right = left + lefts, right + rights
            proof = digest("".join(a + b for a, b in zip(left, right)))
            rows.append((left, right, proof, folded(now, left, right)))
        proved = pd.DataFrame(rows, columns=["lefts", "rights", "proof_sha256", "folded_root"], index=block.index)
        given = block[["doc_id", "tree", "position"]].assign(
            leaf=block["digest"], subroot=above["subroot"].iloc[0], root=above["root"].iloc[0]
        )
        return pd.concat([given, proved], axis=1)

    blocks = leaves.groupBy("tree", superblock(depth))
    return blocks.cogroup(outer.groupBy("tree", F.col("position").alias("block"))).applyInPandas(prove, PROOFS)


def proofs(docs: DataFrame, now: Column, depth: int = DEPTH) -> DataFrame:
    """A proof for every row of ``docs``, folded with ``now`` in place of the text.

    Columns: doc_id, tree, position, leaf, subroot, root, lefts and rights (sibling digests by level, up to the root),
    proof_sha256 (digest of the siblings), folded_root (from ``now`` and the siblings), verified (it equals root).
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # keeps byte order, null first
    rows = docs.select(F.col("doc_id").cast("long"), tree.alias("tree"), leaf(F.col("text")).alias("digest"), leaf(now).alias("now"))
    leaves = ranked(stored(rows, "leaves"), "doc_id", "digest")
    rounds = towers(leaves, depth)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang_tree"), "digest")
    languages = ranked(subroots, "lang_tree")
    tops = towers(languages, depth)
    path = tops[-1].select("tree", "position", *empty_path())
    for nodes in reversed(tops[:-1]):
        path = stored(descended(nodes, path, depth), "paths")
    named = languages.select("position", F.col("lang_tree").alias("tree"), F.col("digest").alias("subroot"))
    root = tops[-1].select("tree", F.col("digest").alias("root"))  # one row
    ends = stored(path.join(named.withColumnRenamed("tree", "named"), "position").join(root, "tree"), "languages")
    outer = ends.select(F.col("named").alias("tree"), F.lit(0).cast("long").alias("position"), "lefts", "rights")
    for nodes in reversed(rounds[1:-1]):
        outer = stored(descended(nodes, outer, depth), "paths")
    known = ends.select(F.col("named").alias("tree"), "subroot", "root")
    found = exchanged(leaves, outer.join(known, "tree"), depth)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered() -> Column:
    """The text, with A-Z in lower case where 3 divides the crc32 of the id."""
    return F.when(id_remainder("doc_id", 3) == 0, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
