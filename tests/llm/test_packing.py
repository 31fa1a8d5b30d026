import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strataledger.llm.packing import merged, pack, pieces_of, tails

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, encode, capacity=2048):
    """Every id in exactly one piece, sequences gapless and within the capacity; returns the padding."""
    ids = {doc_id: encode(text) for doc_id, text in texts}
    covered, sequences = {}, {}
    for r in rows:
        piece = np.frombuffer(r["ids"], "<u4")
        assert len(piece) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert list(piece) == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        covered.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(covered) == set(ids)
    for doc_id, spans in covered.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == len(ids[doc_id])
    padding = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(1, sum(map(len, ids.values())))


def test_packs_the_whole_table(spark, encode):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    padding = check(pack(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], encode)
    assert padding < 0.02


def test_odd_texts(documents, encode):
    texts = [
        None, "", " ", "  a  b ", "a \n b\t c", "a  b  c", "x" * 9000, "one two " * 4000, "<|endoftext|> a",
        "ab\n\n cd", "trailing ", " leading", "don't we'll 12 345  6", "あ いう \U0001f600 z",
    ]
    rows = [(n, t) for n, t in enumerate(texts)]
    check(pack(documents(rows)).collect(), rows, encode)


def test_repeated_rows_null_ids_and_empty_table(documents):
    rows = pack(documents([(5, "a b c"), (5, "a b c"), (None, "a"), (None, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["length"]) for r in rows) == [(-1, 1), (-1, 2), (5, 4), (5, 4)]
    assert pack(documents([])).count() == 0


def test_cuts_and_merging():
    assert all(sum(t) == n for n, t in enumerate(tails(2048)))
    assert pieces_of(5000, 2048)[:2] == [2048, 2048]
    placed = merged([(682, 2), (1024, 1), (64, 31), (1, 5)], 2048)
    assert len(placed) == 39 and max(at + length for length, _, _, at in placed) <= 2048
