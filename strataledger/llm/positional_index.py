"""Distributed positional inverted index, used to find benchmark phrases in training documents.

The index holds one posting (document, term, position) for every training token whose term occurs in a test
text; other terms cannot take part in a match. It is stored once. A phrase is searched from its rarest term:
that term's postings, shifted by its offset, give the candidate starts; these are intersected with the
shifted postings of the second rarest term, and what is left with those of all other terms. Only the postings of
documents that still have candidates are read in the later steps. All of it is joins and grouping, and no
step lists pairs of documents.

A proximity match is found from the same lists: an occurrence of the phrase's rarest term counts if all its other
different terms lie at most ``NEAR`` words away, in any order. Positions are cut into blocks, so a list is only compared
with the neighbouring blocks of its document. The two rarest terms decide first; the words around what is left, at
most 2 * NEAR + 1 of them, then decide on all phrases at once. Of equally rare terms the first of the phrase counts as rarest.

Words are runs of characters other than ASCII separators after lower-casing A-Z. Documents are
told apart by a 128-bit hash of id and text, so repeated rows are one document to the index and each
get the result.

Defined results: null or empty texts have no words, no hits and no items; test texts without words match nothing.
A test text without an id marks words as hit but is not counted as an item. Of repeated test rows one counts. An
empty table on either side gives no hits. Columns other than ids and texts are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.llm.common import small_side, stored

WINDOW = 10
# Two words more than a window has, so that a window with words put in, left out or moved is still found.
NEAR = WINDOW + 2
# ASCII characters that separate words; upper-case letters are turned into lower case first.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(word: Column) -> Column:
    return F.when(word == F.lower(word), word).otherwise(F.translate(word, UPPER, LOWER))


def raw_words(text: Column) -> Column:
    """Words in their own case; empty strings stand for separators at either end."""
    return F.split(F.coalesce(text, F.lit("")), SEPARATORS)


def phrases(items: DataFrame) -> DataFrame:
    """Columns phrase (its words, joined), words, n and item_id: all windows of all test texts."""
    words = F.transform(F.filter(raw_words(F.col("text")), lambda w: w != ""), ascii_lower)
    listed = items.select("item_id", words.alias("all")).where(F.size("all") > 0).withColumn("length", F.size("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.col("length") - (WINDOW - 1), F.lit(1)))
    windows = listed.select("item_id", "all", F.explode(starts).alias("start"))
    cut = windows.select("item_id", F.slice("all", F.col("start"), WINDOW).alias("words"))
    return cut.select(F.array_join("words", " ").alias("phrase"), "words", F.size("words").alias("n"), "item_id").distinct()


def document_key() -> Column:
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    own = F.concat(F.length(doc_id).cast("string"), F.lit(":"), doc_id, F.coalesce("text", F.lit("")))
    return F.unhex(F.md5(own))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (doc, word, pos) of all ``terms``, and one row (doc, doc_id, n_words) without a word per document row."""
    split = docs.select(document_key().alias("doc"), "doc_id", raw_words(F.col("text")).alias("words"))
    size = F.size("words")
    ends = (F.get("words", F.lit(0)) == "").cast("int") + ((size > 1) & (F.get("words", size - 1) == "")).cast("int")
    # The null behind the last word carries the document's own row.
    tokens = split.select(
        "doc", "doc_id", (size - ends).cast("long").alias("n_words"), F.posexplode(F.array_append("words", F.lit(None).cast("string"))).alias("pos", "raw")
    )
    tokens = tokens.where("raw is null or raw != ''").withColumn("word", ascii_lower(F.col("raw")))
    known = terms.select("word", F.lit(True).alias("known"))
    kept = tokens.join(small_side(known), "word", "left").where("known or raw is null")
    own = F.col("word").isNull()
    return stored(
        kept.select("doc", F.when(own, F.col("doc_id")).alias("doc_id"), F.when(own, F.col("n_words")).alias("n_words"), "word", "pos"),
        "postings",
    )


def postings(index: DataFrame) -> DataFrame:
    return index.where("word is not null").select("doc", "word", "pos")


def by_rarity(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Phrases all of whose words occur, with column terms: (number of postings, offset, word), rarest first."""
    counts = stored(postings(index).groupBy("word").agg(F.count(F.lit(1)).alias("postings")), "counts")
    words = wanted.select("phrase", "words", "n").distinct()
    # A frequent word stands in very many phrases, so its count goes to them.
    terms = words.select("phrase", "n", F.posexplode("words").alias("offset", "word")).join(small_side(counts), "word")
    ranked = terms.groupBy("phrase", "n").agg(F.sort_array(F.collect_list(F.struct("postings", "offset", "word"))).alias("terms"))
    return stored(ranked.where(F.size("terms") == F.col("n")), "phrases")  # at most WINDOW terms each


def phrase_matches(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """Columns doc, phrase, n and start of every exact occurrence of every phrase of ``by_rarity``."""

    def lists(place: int) -> DataFrame:
        term = F.get("terms", F.lit(place))
        return ranked.where(F.size("terms") > place).select("phrase", "n", term["word"].alias("word"), term["offset"].alias("offset"))

    # A repeated row has the same postings twice.
    rarest = postings(index).join(small_side(lists(0)), "word").select("phrase", "n", "doc", (F.col("pos") - F.col("offset")).alias("start"))
    starts = stored(rarest.where("start >= 0").distinct(), "starts")
    single = starts.where("n = 1")
    second = starts.where("n > 1").join(lists(1).drop("n"), "phrase")
    second = second.withColumn("pos", F.col("start") + F.col("offset"))
    in_docs = postings(index).join(small_side(lists(1).select("word").distinct()), "word", "left_semi")
    in_docs = in_docs.join(small_side(starts.select("doc").distinct()), "doc", "left_semi").distinct()
    # Both sides grow with the documents, so both are sorted.
    both = stored(second.hint("merge").join(in_docs, ["doc", "pos", "word"]).select("phrase", "n", "doc", "start"), "starts")
    others = ranked.select("phrase", F.explode(F.slice("terms", 3, WINDOW)).alias("term"))
    asked = both.where("n > 2").join(others, "phrase").select(
        "phrase", "n", "doc", "start", (F.col("start") + F.col("term.offset")).alias("pos"), F.col("term.word").alias("word")
    )
    left = postings(index).join(small_side(both.select("doc").distinct()), "doc", "left_semi").distinct()
    complete = asked.hint("merge").join(left, ["doc", "pos", "word"]).groupBy("phrase", "n", "doc", "start").agg(F.count(F.lit(1)).alias("found"))
    whole = complete.where(F.col("found") == F.col("n") - 2).select("phrase", "n", "doc", "start")
    return single.union(both.where("n = 2")).union(whole).select("doc", "phrase", "n", "start")


def proximity_matches(index: DataFrame, ranked: DataFrame, reach: int = NEAR) -> DataFrame:
    """Columns doc, phrase and pos: occurrences of a phrase's rarest term that have every other term of the
    phrase, in any order, at most ``reach`` words away."""
    words = F.array_distinct(F.transform("terms", lambda t: t["word"]))
    listed = ranked.select("phrase", words.alias("words"))
    listed = listed.select(
        "phrase",
        F.get("words", F.lit(0)).alias("first"),
        F.coalesce(F.get("words", F.lit(1)), F.get("words", F.lit(0))).alias("second"),
        F.slice("words", 3, WINDOW).alias("others"),
    )
    listed = stored(listed, "listed")
    # The lists of two terms are compared once, in however many phrases these are the rarest.
    pairs = listed.select("first", "second").distinct()
    block = F.floor(F.col("pos") / (reach + 1))
    around = F.explode(F.sequence(block - 1, block + 1)).alias("block")
    anchors = postings(index).withColumnRenamed("word", "first").join(small_side(pairs), "first").distinct()
    anchors = stored(anchors.select("doc", "pos", "first", "second"), "anchors")
    alone = anchors.where("first = second")
    asked = anchors.where("first != second").select("doc", "pos", "first", "second", around)
    held = postings(index).join(small_side(pairs.select(F.col("second").alias("word")).distinct()), "word", "left_semi")
    held = held.join(small_side(anchors.select("doc").distinct()), "doc", "left_semi")
    held = held.select("doc", F.col("word").alias("second"), F.col("pos").alias("at"), block.alias("block")).distinct()
    close = F.abs(F.col("at") - F.col("pos")) <= reach
    together = asked.hint("merge").join(held, ["doc", "block", "second"]).where(close).select("doc", "pos", "first", "second")
    left = stored(alone.union(together.distinct()), "pairs")

    places = left.select("doc", "pos").distinct().select("doc", "pos", around)
    held = postings(index).join(small_side(left.select("doc").distinct()), "doc", "left_semi")
    held = held.select("doc", "word", F.col("pos").alias("at"), block.alias("block"))
    found = places.hint("merge").join(held, ["doc", "block"]).where(close)
    # At most 2 * reach + 1 words lie around a place.
    found = found.groupBy("doc", "pos").agg(F.collect_set("word").alias("found"))
    whole = left.join(found, ["doc", "pos"]).join(small_side(listed), ["first", "second"])
    return whole.where(F.size(F.array_except("others", "found")) == 0).select("doc", "phrase", "pos")


def named_items(matches: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """Columns doc and ``name``: the sorted ids, as text, of the test texts that the matched phrases stand in."""
    named = wanted.where("item_id is not null").select("phrase", F.col("item_id").cast("string").alias("item"))
    found = matches.select("doc", "phrase").distinct().join(small_side(stored(named, "named")), "phrase").select("doc", "item").distinct()
    return found.groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias(name))


def contamination(docs: DataFrame, items: DataFrame, near: bool = False) -> DataFrame:
    """Every document row with its key doc, n_words, n_hit, items (sorted ids as text of the test texts found in it) and contaminated.

    With ``near`` also near_items: ids of the test texts that have a window with a proximity match in it.
    """
    wanted = stored(phrases(items.select("item_id", "text")), "windows")
    index = build_index(docs, wanted.select(F.explode("words").alias("word")).distinct())
    ranked = by_rarity(index, wanted)
    matches = stored(phrase_matches(index, ranked), "matches")
    covered = matches.select("doc", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
    hits = covered.groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit"))
    rows = index.where("word is null").select("doc", "doc_id", "n_words").join(hits, "doc", "left")
    rows = rows.join(named_items(matches, wanted, "items"), "doc", "left")
    lists = ["items"]
    if near:
        rows = rows.join(named_items(proximity_matches(index, ranked), wanted, "near_items"), "doc", "left")
        lists.append("near_items")
    return rows.select(
        "doc",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        *[F.coalesce(name, F.array().cast("array<string>")).alias(name) for name in lists],
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, with all columns, in which no test phrase occurs."""
    hit = stored(contamination(docs, items).where("contaminated").select(F.col("doc").alias("hit_doc")).distinct(), "hits")
    return docs.join(small_side(hit), document_key() == F.col("hit_doc"), "left_anti")
