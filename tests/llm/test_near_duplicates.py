import itertools
import random

import corpus_pipeline
import numpy as np
import pytest

from strataledger.llm import near_duplicates as nd
from strataledger.llm.components import components
from strataledger.llm.shingles import shingle_sets
from strataledger.llm.similarity_sketch import BINS, EMPTY, sketch


def brute(rows):
    """doc_id: (set size, smallest id that links reach)."""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        if len(words) >= 5:
            sets[doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        else:
            sets[doc_id] = {tuple(words)} if words else set()
    label = {doc_id: doc_id for doc_id in sets}
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {doc_id: (len(sets[doc_id]), label[doc_id]) for doc_id in sets}


def check(documents, rows):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(documents(rows)).collect()}
    assert found == brute(rows)


def made_corpus(seed, groups=6, size=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice((3, 6, 40, 120)))]
        for _ in range(rng.randrange(1, size // groups)):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((rng.randrange(10**9), " ".join(text)))
    return list(dict(rows).items())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(documents, seed):
    check(documents, made_corpus(seed, 8, 160))


def test_odd_rows(documents):
    long = " ".join(f"x{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, long), (8, long + " end")]
    check(documents, rows + [(9, "É é a b c d"), (10, "é é a b c d"), (11, "a\x00b c d e f")])


def test_repeated_rows_and_missing_ids(documents):
    text = "a b c d e f g h"
    rows = nd.near_duplicates(documents([(3, text), (3, text), (7, text), (None, text), (None, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in rows if r["doc_id"]) == [(3, 3, True)] * 2 + [(7, 3, False)]
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2
    left = nd.deduplicated(documents([(3, text), (3, text), (7, text), (None, text), (8, "z")])).collect()
    assert sorted(r["doc_id"] or 0 for r in left) == [0, 3, 8] and "sequence_id" in left[0].asDict()


def test_an_id_with_two_texts_keeps_all_links(documents):
    a, b = (" ".join(f"{name}{i}" for i in range(60)) for name in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, a), (5, b + " more"), (5, "something else of five words or so")]
    found = nd.near_duplicates(documents(rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [
        (1, 56, 1), (1, 56, 1), (2, 57, 1), (3, 57, 1), (4, 56, 1), (5, 3, 5), (5, 57, 1),
    ]
    left = nd.deduplicated(documents([*rows, (1, a), (6, ""), (6, None)])).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in left) == [
        (1, a), (1, b), (5, "something else of five words or so"), (6, ""),
    ]


def test_finds_the_links_of_a_table(spark):
    """Recall against all pairs of sf0.01, at the contract's percentage and at the pipeline's."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    made = shingle_sets([(r["text"] or "").encode() for r in rows])
    sets = {r["doc_id"]: frozenset(s.tolist()) for r, s in zip(rows, made)}
    ids = sorted({s: i for i, s in sorted(sets.items(), reverse=True) if s}.values())  # the first id of each set
    for percent, shape in ((85, {}), (80, {"bands": corpus_pipeline.NEAR_BANDS, "height": corpus_pipeline.NEAR_ROWS})):
        label = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(docs, percent, **shape).collect()}
        linked = [
            (a, b)
            for a, b in itertools.combinations(ids, 2)
            if min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b]))
            and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        ]
        assert linked and all(label[a] == label[b] for a, b in linked)


def test_empty_table(documents):
    assert nd.near_duplicates(documents([])).count() == 0
    assert nd.deduplicated(documents([])).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    for size in (1, 2, 10, 1000):
        assert (sketch(rng.integers(0, 1 << 63, size, dtype=np.uint64)) != EMPTY).all()
    pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    agree = [np.mean(sketch(pool[k : 300 + k]) == sketch(pool[k + 50 : 350 + k])) for k in range(0, 50, 5)]
    assert abs(np.mean(agree) - 250 / 350) < 0.06 and len(agree[:1]) == 1 and BINS == 144


def test_shingle_hashes_tell_texts_apart():
    a, b, c = shingle_sets([b"a b c d e f", b" A b\tc d\n e f ", b"a b c d f e"])
    assert list(a) == list(b) and not set(a.tolist()) & set(c.tolist()) and len(a) == 2


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 90)], "a long, b long")
    assert {(r["node"], r["component"]) for r in components(edges).collect()} == {(i, 0) for i in range(41)} | {(90, 90), (100, 90)}


def test_stage_links_from_eighty_percent(spark, documents):
    # 100 shingles each; 90 are shared: 90 / 110 = 0.82. The second pair shares 88: 88 / 112 = 0.79.
    words = [[f"{name}{i}" for i in range(104)] for name in "abcd"]
    near = [*words[0][:94], *words[1][:10]]
    far = [*words[2][:92], *words[3][:12]]
    rows = [(n, " ".join(text)) for n, text in enumerate((words[0], near, words[2], far), 1)]
    left = corpus_pipeline.near_dedup(spark, documents(rows), "")
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4]
    assert sorted(r["doc_id"] for r in nd.deduplicated(documents(rows)).collect()) == [1, 2, 3, 4]
    assert 1 - (1 - 0.8**corpus_pipeline.NEAR_ROWS) ** corpus_pipeline.NEAR_BANDS > 0.9999
