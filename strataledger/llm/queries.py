"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataledger.llm import (
    chat_format,
    context_tree,
    fuzzy_fingerprints,
    hard_negatives,
    language,
    merkle_manifest,
    personal_data,
    positional_index,
    quality_cnn,
    quality_rules,
    toxicity,
)
from strataledger.llm.common import id_remainder, table
from strataledger.llm.near_duplicates import near_duplicates
from strataledger.llm.packing import pack
from strataledger.llm.samples import HELD_OUT_DIVISOR

QUERIES = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = quality_cnn.fit(docs, table(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, net).select(
        "doc_id",
        (id_remainder("doc_id", HELD_OUT_DIVISOR) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_cnn.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op3_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (id_remainder("doc_id", HELD_OUT_DIVISOR) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    found = language.identify(docs, language.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op6_similarity_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = context_tree.score(table(spark, sf_dir, "documents"), id_remainder("doc_id", 10) != 0, across=True)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


OP9_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d CROSS JOIN sizes)),
matches AS (SELECT p.doc_id, p.i, p.n, w.item_id FROM places p JOIN windows w ON p.phrase = w.phrase AND p.n = w.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM matches) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY doc_id),
tokens AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
counts AS (SELECT word, count(*) AS postings FROM tokens GROUP BY word),
asked AS (
    SELECT phrase, word, min(place) AS place FROM (
        SELECT phrase, unnest(string_split(phrase, ' ')) AS word, generate_subscripts(string_split(phrase, ' '), 1) AS place
        FROM (SELECT DISTINCT phrase FROM windows)) GROUP BY phrase, word),
rarest AS (
    SELECT phrase, arg_min(word, (postings, place)) AS word, count(*) AS n_words
    FROM asked LEFT JOIN counts USING (word) GROUP BY phrase HAVING count(postings) = count(*)),
close AS (
    SELECT DISTINCT doc_id, phrase FROM (
        SELECT t.doc_id, t.pos, r.phrase FROM tokens t JOIN rarest r ON t.word = r.word JOIN asked a ON a.phrase = r.phrase
        JOIN tokens o ON o.doc_id = t.doc_id AND o.word = a.word AND o.pos BETWEEN t.pos - 12 AND t.pos + 12
        GROUP BY t.doc_id, t.pos, r.phrase, r.n_words HAVING count(DISTINCT a.word) = r.n_words)),
close_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM close JOIN windows USING (phrase) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
    CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
LEFT JOIN close_items ON d.doc_id = close_items.doc_id
"""


@query
def op9_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near"),
    )


SQL["op9_positional_index"] = OP9_SQL


@query
def op7_ngram_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.judged(table(spark, sf_dir, "documents"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )


@query
def op5_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal_data.find(docs, personal_data.fit(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["strict"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [of_kind(kind) for kind in personal_data.KINDS]
    strict = F.filter("spans", lambda s: s["strict"])
    return found.select(
        "doc_id", *counts, F.sha2(listed(strict).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


OP4_SQL = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM turns),
whole AS (
    SELECT conv_id, count(*) AS turns,
        list(concat('<|', role, '|>', chr(10), text, chr(10), '<|end|>', chr(10)) ORDER BY place) AS said
    FROM placed GROUP BY conv_id),
prefixes AS (SELECT DISTINCT said[1:k] AS said FROM (SELECT said, unnest(range(1, turns)) AS k FROM whole)),
kept AS (
    SELECT min(conv_id) AS conv_id, min(turns) AS turns, said FROM whole
    WHERE said NOT IN (SELECT said FROM prefixes) GROUP BY said),
blocks AS (SELECT conv_id, turns, said, unnest(range(0, (turns - 1) // 256 + 1)) AS block FROM kept)
SELECT conv_id, CAST(turns AS BIGINT) AS turns, CAST(block AS BIGINT) AS block,
    array_to_string(said[block * 256 + 1:block * 256 + 256], '') AS text FROM blocks
"""


@query
def op4_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render(table(spark, sf_dir, "conversations"))


SQL["op4_snapshot_collapse"] = OP4_SQL


OP11_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
    FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
positives AS (
    SELECT anchor_id, vec_id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
paired AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM paired WHERE rank <= 5
"""


@query
def op11_shared_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.participating(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


SQL["op11_shared_lists"] = OP11_SQL


@query
def op12_golay_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_fingerprints.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_subtree_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle_manifest.proofs(table(spark, sf_dir, "documents"), merkle_manifest.tampered())
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
