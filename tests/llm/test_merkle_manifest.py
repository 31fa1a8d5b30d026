import hashlib
import random
import zlib

import pytest

from strataledger.llm import merkle_manifest as mm


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    def part(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return digest("".join(map(part, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def tree(nodes):
    """All levels, built whole."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def path(levels, at):
    found = []
    for level in levels[:-1]:
        run = at // 8 * 8
        found.append((level[run:at], level[at + 1 : run + 8]))
        at //= 8
    return found


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, expected = {}, []
    for lang in langs:
        own = [r for r in rows if r["lang"] == lang]
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[lang] = own, tree([leaf(r, r["text"]) for r in own])
    top = tree([trees[lang][1][-1][0] for lang in langs])
    for number, lang in enumerate(langs):
        own, levels = trees[lang]
        for at, row in enumerate(own):
            whole = path(levels, at) + path(top, number)
            text = row["text"]
            if text is not None and zlib.crc32(str("" if row["doc_id"] is None else row["doc_id"]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(row, text)
            for left, right in whole:
                node = digest("".join([*left, node, *right]))
            proof = digest("".join(d for left, right in whole for d in left + right))
            root = top[-1][0]
            expected.append((-1 if row["doc_id"] is None else row["doc_id"], levels[0][at], levels[-1][0], root, proof, node, node == root))
    return sorted(expected)


def found(docs, **depth):
    rows = mm.proofs(docs, mm.tampered(), **depth).collect()
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, *r[3:6], *r[8:]) for r in rows)


def made(n, langs, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(1, 10 * n), n)
    return [(i, rng.choice(("Abc É", "plain", "", None)) if i % 5 else f"T{i}", rng.choice(langs)) for i in ids]


@pytest.mark.parametrize(
    "n, langs",
    [(1, ["en"]), (8, ["en"]), (9, ["en"]), (65, ["en", None]), (300, ["a", "b", "é", "", None, "z", "aa", "A", "q", "zz"])],
)
def test_equals_whole_trees(documents, n, langs):
    docs = documents(made(n, langs, n))
    assert found(docs) == brute([r.asDict() for r in docs.collect()])


def test_several_rounds_of_superblocks(documents):
    # Superblocks of 8 nodes: the larger language takes four rounds.
    docs = documents(made(700, ["en"] * 8 + ["de", None], 3))
    assert found(docs, depth=1) == brute([r.asDict() for r in docs.collect()])


def test_more_leaves_than_a_superblock(documents):
    docs = documents([(i, "Some Text" if i % 2 else None, "en" if i % 9 else "de") for i in range(5000)])
    assert found(docs) == brute([r.asDict() for r in docs.collect()])


def test_repeated_and_missing_ids(documents):
    docs = documents([(3, "A"), (3, "A"), (3, "b"), (None, "Q"), (None, None), (4, "Long " * 50_000)])
    assert found(docs) == brute([r.asDict() for r in docs.collect()])


def test_empty_table(documents):
    assert mm.proofs(documents([]), mm.tampered()).count() == 0


def test_untampered_rows_verify(documents):
    docs = documents(made(50, ["x", "y"], 1))
    rows = mm.proofs(docs, docs["text"]).collect()
    assert len(rows) == 50 and all(r["verified"] for r in rows)
