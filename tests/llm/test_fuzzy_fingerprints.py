import itertools
import random

import numpy as np
import pytest
import xxhash

from strataledger.llm import fuzzy_fingerprints as ff
from strataledger.llm import golay


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(gram, seed=42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints):
    """(doc_id, fingerprint) rows to the smallest id of each row's component."""
    label = list(range(len(prints)))
    links = [(a, b) for a, b in itertools.combinations(range(len(prints)), 2) if (prints[a][1] ^ prints[b][1]).bit_count() <= 2]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    least = {}
    for (doc_id, _), name in zip(prints, label):
        if doc_id is not None:
            least[name] = min(doc_id, least.get(name, doc_id))
    return [least.get(name) for name in label]


def flipped(rng, value, bits):
    for bit in rng.sample(range(64), bits):
        value ^= 1 << bit
    return value


def test_every_word_has_one_nearest_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 3000)
    table, counts = golay.patterns(3)
    assert (counts == 1).all()  # perfect
    codewords = words ^ table[golay.remainders(words), 0]
    assert (golay.remainders(codewords) == 0).all()
    assert (np.bitwise_count(words ^ codewords) <= 3).all()
    assert set(golay.patterns(4)[1].tolist()) == {1, 6}


@pytest.mark.parametrize("errors, radius", [(1, 4), (2, 5)])
def test_nearest_codeword_is_near_every_close_word(errors, radius):
    rng = random.Random(2)
    for _ in range(300):
        word = rng.randrange(1 << 23)
        other = word
        for bit in rng.sample(range(23), errors):
            other ^= 1 << bit
        index = golay.nearest(np.array([word]))[0]
        assert index in golay.near(np.array([other]), radius)[1]


@pytest.mark.parametrize("hot_probes", [ff.HOT_PROBES, 0, 3])
def test_links_equal_all_pairs(spark, hot_probes):
    rng = random.Random(5)
    values = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        values.update(flipped(rng, base, rng.randrange(5)) for _ in range(8))
    values |= {0, 1, 3, 7, (1 << 64) - 1, 1 << 63}
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {(r["a"], r["b"]) for r in ff.links(nodes, hot_probes).collect()}
    unsigned = {s: v for s, v in zip(signed, values)}
    want = {(a, b) for a, b in itertools.combinations(sorted(signed), 2) if (unsigned[a] ^ unsigned[b]).bit_count() <= 2}
    assert got == want and len(want) > 100


def made_texts():
    rng = random.Random(9)
    words = [f"W{i}" for i in range(300)]
    rows = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice((1, 2, 3, 30, 200)))]
        for _ in range(rng.randrange(1, 6)):
            text = list(base)
            for _ in range(rng.randrange(2)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((rng.randrange(10**6), " ".join(text)))
    return rows


def check(documents, rows):
    got = ff.near_duplicates(documents(rows)).collect()
    prints = [(doc_id, plain_fingerprint(text)) for doc_id, text in rows]
    want = [(i or -1, f"{p:016x}", c) for (i, p), c in zip(prints, smallest_reachable(prints))]
    key = lambda row: (row[0], row[1], -1 if row[2] is None else row[2])
    assert sorted(((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in got), key=key) == sorted(want, key=key)


def test_equals_plain_search(documents):
    check(documents, made_texts())


def test_odd_rows(documents):
    long = " ".join(f"x{i % 977}" for i in range(150_000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "One two"), (9, "one  TWO"), (10, long), (11, long.upper()), (12, "É é a\x00b")]
    check(documents, rows + [(8, "other words of the same id"), (8, "One two"), (None, "one two"), (None, "alone here now")])


def test_empty_table(documents):
    assert ff.near_duplicates(documents([])).count() == 0
