import hashlib
import re

import pytest

from strataledger.llm import personal_data as pd
from strataledger.llm import queries


@pytest.fixture(scope="module")
def finder():
    return pd.fit_examples([["word", "another", "thing", "we", "said", "today", "and"] * 5])


def plain_rules(text):
    """The four rules run over the whole text."""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append(("phone", *m.span()))
    return spans


TEXTS = [
    "", "nothing here", "a.b@c.de, x@y and a@b@c.com.d e@f.g@h.i", "1.2.3.4.5 256.1.1.1 01.02.003.4 1.2.3", "4111 1111 1111 1111 4111111111111112",
    "+1 (555) 010-9999 +49 30 12 +123456789012345678", "4111-1111-1111-1111 2 é 4012888888881881", "\U0001f600 me@x.org \U0001f600 10.0.0.1",
    "@" * 50 + "a@b.c" + "@" * 50, "9" * 5000, "a" * 5000 + "@" + "b" * 5000 + ".c", "+" + "1 " * 3000, "1." * 4000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_strict_rules_equal_plain_search(text):
    assert pd.strict_spans(text) == plain_rules(text)


def test_strict_spans_stay_and_offsets_are_code_points(finder):
    text = "\U0001f600 me@x.org then 10.0.0.1 \U0001f600 card 4012888888881881"
    found = finder.spans(text)
    assert [text[s:e] for _, s, e, *_ in found] == ["me@x.org", "10.0.0.1", "4012888888881881"]
    assert all(strict for *_, strict, _ in found)


@pytest.mark.parametrize("value, kind", [("jo [at] mail [dot] com", "email"), ("(415) 555-0133", "phone"), ("10[.]1[.]20[.]3", "ip"), ("4539578763621487", "card")])
def test_added_spans(finder, value, kind):
    text = f"we said today {value} and another thing"
    assert [(k, text[s:e]) for k, s, e, *_ in finder.spans(text)] == [(kind, value)]


@pytest.mark.parametrize("text", ["on 2024-03-05 we met", "version 3.11.2.1000 and 12.345", "order 12345678 paid 1,234,567.89", "we met at noon. Then home", "Apache License, Version 2.0."])
def test_look_alikes_are_left_alone(finder, text):
    assert finder.spans(text) == []


def test_trees_on_unseen_examples(finder):
    rows, labels = pd.examples([["other", "text", "with", "words", "in", "it"] * 5], 2000, seed=77)
    likely = finder.trees.probability(rows)
    for number, kind in enumerate(pd.KINDS):
        own = rows[:, 0] == number
        hit = likely[own] >= finder.thresholds[kind]
        assert labels[own][hit].mean() > 0.95 and hit[labels[own] == 1].mean() > 0.85


def test_rows_and_redaction(documents, finder):
    rows = [(1, None), (2, ""), (3, "mail a@b.cd now"), (3, "mail a@b.cd now"), (None, "+1 (555) 010-9999")]
    found = pd.find(documents(rows), finder).collect()
    assert sorted(len(r["spans"]) for r in found) == [0, 0, 1, 1, 1]
    clean = pd.redact(documents(rows), finder)
    assert clean.columns == documents(rows).columns
    assert sorted(str(r["text"]) for r in clean.collect()) == ["", "<phone>", "None", "mail <email> now", "mail <email> now"]
    assert pd.find(documents([]), finder).count() == 0
    assert pd.redacted_text("abcdef", [("x", 1, 4), ("y", 2, 5)]) == "a<x>f"


def test_query_equals_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in queries.op5_boosted_candidates(spark, sf).collect():
        spans = plain_rules(texts[row["doc_id"]])
        assert [row[f"n_{k}"] for k in pd.KINDS] == [sum(s[0] == k for s in spans) for k in pd.KINDS]
        listed = [f"{k}:{s}:{e}" for k, s, e in spans]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row["spans"].split(",")) if listed else True


ADJACENT = [
    ("555-123-4567 555-987-6543", [("phone", "555-123-4567"), ("phone", "555-987-6543")]),
    ("4111 1111 1111 1111 5500 0000 0000 0004", [("card", "4111 1111 1111 1111"), ("card", "5500 0000 0000 0004")]),
    ("17 4111 1111 1111 1111 12/26", [("card", "4111 1111 1111 1111")]),
    ("555-123-4567 2024-01-05", [("phone", "555-123-4567")]),
    ("jo at mail.com", [("email", "jo at mail.com")]),
]


@pytest.mark.parametrize("values, expected", ADJACENT)
def test_values_beside_other_numbers(finder, values, expected):
    text = f"we said today {values} and another thing"
    assert {(k, text[s:e]) for k, s, e in pd.candidates(text)} >= set(expected)
    assert [(k, text[s:e]) for k, s, e, *_ in finder.spans(text)] == expected


def test_candidates_grow_with_the_text():
    sizes = [len(pd.candidates("12 345 6 " * n)) for n in (200, 400)]
    assert sizes[1] < 2.1 * sizes[0]
