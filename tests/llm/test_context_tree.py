import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataledger.llm import context_tree as ct


def log_kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)


class Tree:
    """Context-tree weighting by recursion, one tree per decision node of a byte."""

    def __init__(self, words):
        self.counts = Counter()
        for word, n in words.items():
            for context, node, bit in self.decisions(word):
                for depth in range(ct.DEPTH + 1):
                    self.counts[node, context[ct.DEPTH - depth :], bit] += n
        self.children = {}
        for node, context, _ in list(self.counts):
            if context:
                self.children.setdefault((node, context[1:]), set()).add(context)
        self.memo = {}

    @staticmethod
    def decisions(word):
        spelled = b" " * ct.DEPTH + word + b" "
        for i in range(len(word) + 1):
            byte = spelled[i + ct.DEPTH]
            for k in range(8):
                yield spelled[i : i + ct.DEPTH], (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1

    def weighted(self, node, context):
        key = node, context
        if key not in self.memo:
            own = log_kt(self.counts[node, context, 0], self.counts[node, context, 1])
            if len(context) < ct.DEPTH:
                below = sum(self.weighted(node, c) for c in self.children.get(key, ()))
                own = math.log(0.5 * math.exp(own) + 0.5 * math.exp(below))
            self.memo[key] = own
        return self.memo[key]

    def one(self, node, context, depth):
        """Probability of a one, mixing from this depth on; contexts that training lacks end the path."""
        here = context[ct.DEPTH - depth :]
        zeros, ones = self.counts[node, here, 0], self.counts[node, here, 1]
        share = (ones + 0.5) / (zeros + ones + 1)
        deeper = context[ct.DEPTH - depth - 1 :] if depth < ct.DEPTH else None
        if deeper is None or not self.counts[node, deeper, 0] + self.counts[node, deeper, 1]:
            return share
        cut = 0.5 * math.exp(log_kt(zeros, ones) - self.weighted(node, here))
        return cut * share + (1 - cut) * self.one(node, context, depth + 1)

    def score(self, word):
        total = 0.0
        for context, node, bit in self.decisions(word):
            one = self.one(node, context, 0)
            total += math.log10(one if bit else 1 - one)
        return total


TEXTS = [
    (0, "the cat and The hat"), (1, "that there this"), (2, None), (3, ""), (4, "hat\x00 é the\tthe"), (5, "théâtre the cat"),
    (5, "théâtre the cat"), (None, "cat cats"), (7, "unseenword the"), (8, " \n "),
]


def brute(rows, learn):
    tokens = [(doc_id, (text or "").encode().lower().split() + [b"\n"]) for doc_id, text in rows]
    counts = Counter(w for doc_id, words in tokens if learn(doc_id) for w in words)
    tree, total, kinds = Tree(counts), sum(counts.values()), len(counts)
    for doc_id, words in tokens:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        yield doc_id, len(words), sum(counts[w] > 0 for w in words), total, base, sum(map(tree.score, words))


@pytest.mark.parametrize("top, local", [(200_000, 4_000_000), (2, 4_000_000), (2, -1)])
def test_equals_recursion_on_either_path(documents, monkeypatch, top, local):
    monkeypatch.setattr(ct, "TOP", top)
    monkeypatch.setattr(ct, "LOCAL_EVENTS", local)
    found = ct.score(documents(TEXTS), F.coalesce(F.col("doc_id"), F.lit(0)) != 7).collect()
    expected = sorted(brute(TEXTS, lambda doc_id: (doc_id or 0) != 7), key=repr)
    rows = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found), key=repr)
    assert len(rows) == len(expected)
    for row, other in zip(rows, expected):
        assert row[:4] == other[:4]
        assert row[4:] == pytest.approx(other[4:], abs=1e-5)
    assert all(r["bits_per_byte"] > 0 for r in found)


def test_probabilities_of_a_byte_add_up():
    words = {b"abc": 5, b"abd": 2, b"\n": 3}
    tree = Tree(Counter(words))
    for context in (b"    ab", b"      ", b"  zzzz"):
        total = 0.0
        for byte in range(256):
            p = 1.0
            for k in range(8):
                one = tree.one((1 << k) | (byte >> (8 - k)), context, 0)
                p *= one if (byte >> (7 - k)) & 1 else 1 - one
            total += p
        assert total == pytest.approx(1)


def test_without_training_rows_and_without_rows(documents):
    row = ct.score(documents([(1, "ab")]), F.lit(False)).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0
    assert row["score"] == pytest.approx((3 + 2) * 8 * math.log10(0.5), abs=1e-4)
    assert ct.score(documents([]), F.lit(True)).count() == 0


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.0, 1e3, 1e9])
    assert ct.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-10, abs=1e-9)


@pytest.mark.parametrize("top, local", [(200_000, 4_000_000), (2, 20), (2, -1)])
def test_contexts_run_over_the_words_before(documents, monkeypatch, top, local):
    monkeypatch.setattr(ct, "TOP", top)
    monkeypatch.setattr(ct, "LOCAL_EVENTS", local)
    texts = [*TEXTS, (8, "cat the"), (9, "the cat"), (7, "hat and"), (None, "a b\nC  d")]
    running = [(doc_id, b" ".join([*(text or "").encode().lower().split(), b"\n"])) for doc_id, text in texts]
    tree = Tree(Counter(text for doc_id, text in running if doc_id != 7))  # a running text is spelled like one word
    expected = sorted(((doc_id, tree.score(text)) for doc_id, text in running), key=repr)
    found = ct.score(documents(texts), F.coalesce(F.col("doc_id"), F.lit(0)) != 7, across=True).collect()
    rows = sorted(((r["doc_id"], r["score"]) for r in found), key=repr)
    assert [row[0] for row in rows] == [row[0] for row in expected]
    assert [row[1] for row in rows] == pytest.approx([row[1] for row in expected], abs=1e-5)
    by_order = {r["doc_id"]: r["score"] for r in found if r["doc_id"] in (8, 9) and r["n_tokens"] == 3}
    assert abs(by_order[8] - by_order[9]) > 0.01


def test_query_reads_running_text(spark, tmp_path):
    from strataledger.llm.queries import QUERIES

    texts = [(i, "one two three four " * 5) for i in range(30)] + [(31, "four three two one " * 5)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(path)
    score = {r["doc_id"]: r["score"] for r in QUERIES["op2_context_tree"](spark, str(tmp_path)).collect()}
    assert score[0] > score[31] + 1


def test_windows_and_runs_do_not_change_events(monkeypatch):
    words = [b"the", b"cat", b"and", b"t" * 40, b"\n"] * 3
    for across in (True, False):
        whole = np.concatenate([ct.events_of(w)[0] for w, _ in ct.spelled_in([words, words[:2]], across)])
        monkeypatch.setattr(ct, "WINDOW", 7)
        monkeypatch.setattr(ct, "RUN", 11)
        tally, parts = ct.Tally(), []
        for windows, _ in ct.spelled_in([words, words[:2]], across):
            parts.append(ct.events_of(windows)[0])
            tally.add(parts[-1], True)
            tally.add(parts[-1], False)
        monkeypatch.undo()
        assert (np.concatenate(parts) == whole).all()
        tally.fold()
        events, n = np.unique(whole, return_counts=True)
        assert (tally.events == events).all() and (tally.n == n).all()


def test_subtrees_stay_whole(monkeypatch):
    monkeypatch.setattr(ct, "SUBTREES", 3)
    shift = 8 * (ct.DEPTH + 1 - ct.SHALLOW)
    events = np.array([5, 1, 1, 2, 9, 5, 5, 5, 7], np.int64) << shift
    seen = []
    for places, first, last in ct.subtrees(events):
        tails = events[places] >> shift
        assert tails.min() == first and tails.max() == last and not {*tails} & {t for part in seen for t in part}
        seen.append([*tails])
    assert len(seen) > 1 and sum(map(len, seen)) == len(events)
