"""Operators that use DataFrame functions only, against plain Python."""


import math
import random
import re
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import types as T

from strataledger.llm import chat_format, positional_index, quality_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    None, "", " \t\n", "a", "a a a", "a a a a", "x y x y x", "a b c\na b c\n\na b c \nd", "# * $ % & | < >", "é \U0001f600 é\x0bé\x0cz\r\nq",
    "one two three one two three one two", "w " * 3000, " ".join(f"t{i}" for i in range(30_000)), "a\x00b c", "||||", " a b c d a b c ",
]


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def bucket(*words):
    value = 42
    for word in words:
        value = xxhash.xxh64_intdigest(word.encode(), seed=value)
    return value % quality_rules.BUCKETS if value < 1 << 63 else (value - (1 << 64)) % quality_rules.BUCKETS


def test_quality_rules_equal_plain_python(documents, spark):
    rows = list(enumerate(ODD)) + [(50, "a a a a"), (50, "a a a a"), (None, "a b c d")]
    rng = random.Random(4)
    rows += [(100 + n, " ".join(rng.choice("ab cd ef gh ### ij kl".split()) for _ in range(80))) for n in range(10)]
    trusted = spark.createDataFrame([(12,), (103,), (104,), (104,), (None,)], "doc_id long")
    found = quality_rules.judged(documents(rows), trusted).collect()
    grams = {t: [bucket(w) for w in WORD.findall(t or "")] + [bucket(*p) for p in zip(*[WORD.findall(t or "")[k:] for k in (0, 1)])] for _, t in rows}
    raw = Counter(b for _, t in rows for b in grams[t])
    target = Counter(b for i, t in rows if i in (12, 103, 104) for b in grams[t])
    size = quality_rules.BUCKETS
    weight = [
        math.log((target[b] + 1) / (sum(target.values()) + size)) - math.log((raw[b] + 1) / (sum(raw.values()) + size)) for b in range(size)
    ]
    expected = []
    for doc_id, text in rows:
        numbers = counted(text)
        ratio = sum(weight[b] for b in grams[text]) / max(1, 2 * numbers[0] - 1)
        failed = numbers[0] < 50 or 100 * numbers[4] > 50 * numbers[0]
        expected.append((str(doc_id), *numbers, round(ratio, 9), failed, not failed and ratio >= quality_rules.THRESHOLD))
    result = [(str(r["doc_id"]), *[r[c] for c in STATISTICS], round(r["ratio"], 9), r["base_failed"], r["kept"]) for r in found]
    assert sorted(result) == sorted(expected)


def test_quality_rules_without_trusted_rows_or_rows(documents, spark):
    nobody = spark.createDataFrame([], "doc_id long")
    assert {r["ratio"] for r in quality_rules.judged(documents(["a b c d", None]), nobody).collect()} == {0.0}
    assert quality_rules.judged(documents([]), nobody).count() == 0


def test_quality_rules_keep_clean_and_drop_junk(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = queries.op7_ngram_ratio_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(clean) / len(clean) > 0.99 and sum(junk) / len(junk) < 0.2


SEPARATED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return SEPARATED.findall(lowered)


def contaminated(docs, items):
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - 9)) if words else ():
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item_id)
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (window := tuple(words[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[window] - {None}
        yield str(doc_id), len(words), len(hit), sorted(map(str, found)), bool(hit)


def near_items(docs, items, reach=positional_index.NEAR):
    """Per document row the items of which a window has all its words around its rarest one."""
    texts = [words_of(text) for _, text in docs]
    counts = Counter(word for words in texts for word in words)
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - 9)) if words and item_id is not None else ():
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item_id)
    for (doc_id, _), words in zip(docs, texts):
        found = set()
        for window, owners in windows.items():
            rarest = min(window, key=lambda w: (counts[w], window.index(w)))
            if any(word == rarest and set(window) <= set(words[max(0, i - reach) : i + reach + 1]) for i, word in enumerate(words)):
                found |= owners
        yield str(doc_id), sorted(map(str, found))


def items_table(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


def test_positional_index_equals_plain_search(documents, spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)] + ["the"] * 6 + ["Ä", "É", "é9"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(n, some(rng.choice((1, 2, 3, 10, 14, 25)))) for n in range(12)]
    items += [(20, None), (21, ""), (22, "..."), (23, "Unseen the"), (None, some(11)), (24, items[3][1]), (24, items[3][1]), (10, "W1, w2.")]
    docs = []
    for n in range(25):
        inside = rng.choice(items)[1] or ""
        docs.append((n, f"{some(rng.randrange(30))} {inside.upper()} . {some(rng.randrange(9))}"))
    docs += [(90, None), (91, ""), (92, "\x00 -"), (93, docs[0][1]), (0, docs[0][1]), (None, items[5][1]), (95, "the " * 9000)]
    # Words put into a window, moved and left out.
    docs += [(200 + n, " ".join([*words_of(t)[:3], "zz", *words_of(t)[5:9], "yy", *words_of(t)[3:5], *words_of(t)[9:]])) for n, t in items if n]
    found = positional_index.contamination(documents(docs), items_table(spark, items), near=True).collect()
    near = list(near_items(docs, items))
    assert sorted((str(r["doc_id"]), r["near_items"]) for r in found) == sorted(near)
    assert any(set(r["near_items"]) - set(r["items"]) for r in found)
    result = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found)
    assert result == sorted(contaminated(docs, items))
    left = positional_index.decontaminated(documents(docs), items_table(spark, items))
    assert left.columns == documents(docs).columns
    assert left.count() == sum(not hit for *_, hit in contaminated(docs, items))


def test_positional_index_on_empty_tables(documents, spark):
    assert positional_index.contamination(documents([]), items_table(spark, [(1, "a b")])).count() == 0
    row = positional_index.contamination(documents(["a b"]), items_table(spark, [])).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (2, 0, [])


def test_proximity(documents, spark):
    docs = documents([(1, "rare a b c d e f common"), (2, "common x rare"), (3, "rare rare"), (4, "common common rare y common"), (5, "common")])
    wanted = positional_index.phrases(items_table(spark, [(1, "Common rare")]))
    index = positional_index.build_index(docs, spark.createDataFrame([("common",), ("rare",)], "word string"))
    ranked = positional_index.by_rarity(index, wanted)
    names = {r["doc"]: r["doc_id"] for r in index.where("doc_id is not null").collect()}
    near = lambda reach: sorted((names[r["doc"]], r["pos"]) for r in positional_index.proximity_matches(index, ranked, reach).collect())
    assert near(7) == [(1, 0), (2, 2), (4, 2)]
    assert near(2) == [(2, 2), (4, 2)]
    assert near(1) == [(4, 2)]


CONVERSATION = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType())]
    + [T.StructField("text", T.StringType()), T.StructField("block", T.StringType()), T.StructField("place", T.StringType())]
)


def rendered(rows):
    by_id = {}
    for conv_id, turn, role, text in set(rows):
        if conv_id is not None:
            by_id.setdefault(conv_id, set()).add((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(turns)] for c, turns in by_id.items()}
    for conv_id, turns in said.items():
        longer = any(other[: len(turns)] == turns and len(other) > len(turns) for other in said.values())
        if not longer and conv_id == min(c for c, other in said.items() if other == turns):
            for block in range(0, len(turns), chat_format.BLOCK):
                text = "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in turns[block : block + chat_format.BLOCK])
                yield conv_id, len(turns), block // chat_format.BLOCK, text


def check_chat(spark, rows):
    table = spark.createDataFrame([(*row, "x", "y") for row in rows], CONVERSATION).repartition(3)
    found = sorted((r["conv_id"], r["turns"], r["block"], r["text"]) for r in chat_format.render(table).collect())
    assert found == sorted(rendered(rows))


def test_chat_equals_plain_python(spark):
    rng = random.Random(6)
    rows = []
    for conv_id in range(40):
        base = random.Random(rng.randrange(4))
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv_id, turn, base.choice(("user", "assistant", None)), base.choice(("a", "b", "", None))))
    check_chat(spark, rows)


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, None, None), (2, 0, "user", "hi"), (3, None, "user", "hi"), (3, -5, "x", "")]
    rows += [(None, 0, "user", "lost"), (4, 7, "user", "hi"), (4, 7, "bot", "tie"), (5, 10**15, "user", "y" * 50_000)]
    rows += [(6, t, "user", str(t)) for t in range(700)] + [(7, t, "user", str(t)) for t in range(500)] + [(8, 3 * t, "user", str(t)) for t in range(300)]
    check_chat(spark, rows)
    check_chat(spark, [])




@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    duck, folder = duckdb.connect(), "/root/testdata/sf0.001"
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    cursor = duck.execute(queries.SQL[name])
    columns = [d[0] for d in cursor.description]
    found = queries.QUERIES[name](spark, folder).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(cursor.fetchall())
