"""Prefix encoding against tiktoken, under appends and edits, and back."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
import tiktoken

from harborlog.llm import bpe, queries

public_tokenizers = pytest.importorskip("public_tokenizers")

WILD = ["aaaa", "'s", "'ll", " ", "  ", "\n", "\n\n ", "\t", "é", "漢字", "🙂", "word", "Word", "123", "4567", "!!", "...", "\x00", "ing", "the ", "ab" * 40, "　", "ا", "'", "r", "e"]


@pytest.fixture(scope="module")
def known():
    return bpe.Vocabulary(*queries.byte_bpe())


@pytest.fixture(scope="module")
def plain(known):
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known.rank, special_tokens={})


def wild(chance, k):
    return "".join(chance.choices(WILD, k=k))


def test_same_as_tiktoken(known, plain):
    chance = random.Random(1)
    for _ in range(600):
        text = wild(chance, chance.randint(0, 60))
        ids = known.encode(text).tolist()
        assert ids == plain.encode_ordinary(text) and known.decode(ids) == text.encode()


def test_neighbours_are_what_merging_leaves_alone(known):
    chance = random.Random(7)
    ranks = list(known.bytes)
    for _ in range(30_000):
        left, right = chance.choice(ranks), chance.choice(ranks[: chance.choice([300, 3_000, len(ranks)])])
        assert known._apart(left, right) == (known.merged(known.bytes[left] + known.bytes[right]) == [left, right])
    # Pairs that come from cutting tokens in two are the ones most likely to be merged otherwise.
    for token in chance.sample(ranks, 20_000):
        data = known.bytes[token] + known.bytes[chance.choice(ranks[:2_000])]
        cut = chance.randint(1, len(data) - 1)
        left, right = known.rank.get(data[:cut]), known.rank.get(data[cut:])
        if left is not None and right is not None:
            assert known._apart(left, right) == (known.merged(data) == [left, right])


def test_long_texts_and_pieces(known, plain):
    chance = random.Random(2)
    letters = "".join(chance.choices("abcde", k=300_000))
    for text in ["a" * 20_000, " " * 50_000 + "x", letters, "wörd " * 300_000, wild(chance, 400_000), "=" * 3_000]:
        assert known.encode(text).tolist() == plain.encode_ordinary(text)


def test_a_piece_longer_than_a_segment(known, plain, monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", 50)
    chance = random.Random(3)
    for _ in range(100):
        text = wild(chance, 60) + "x" * chance.randint(0, 300) + wild(chance, 60)
        assert known.encode(text).tolist() == plain.encode_ordinary(text)


def test_every_prefix_and_append_of_a_piece(known, plain):
    chance = random.Random(4)
    for _ in range(60):
        data = bytes(chance.choices(b"abehilnorst \xc3\xa9\xff", k=chance.randint(1, 60)))
        grown = bpe.Prefixes(known)
        for at in range(0, len(data), 7):
            grown.append(data[at : at + 7])
        for n in range(1, len(data) + 1):
            assert grown.ids(n) == plain._encode_single_piece(data[:n]) or known.rank.get(data[:n]) is not None
        assert b"".join(known.bytes[t] for t in grown.ids()) == data


def test_edit_of_a_piece_is_exact_and_near(known):
    chance = random.Random(5)
    for _ in range(200):
        data = bytes(chance.choices(b"abehilnorst", k=chance.randint(0, 900)))
        edited = bpe.Prefixes(known, data)
        start = chance.randint(0, len(data))
        stop = chance.randint(start, min(len(data), start + 5))
        new = bytes(chance.choices(b"abehilnorst", k=chance.randint(0, 6)))
        done = edited.replace(start, stop, new)
        whole = bpe.Prefixes(known, data[:start] + new + data[stop:])
        assert edited.last == whole.last and edited.ids() == whole.ids()
        assert done <= len(new) + 4 * known.longest


def test_document_under_appends_and_edits(known, plain):
    chance = random.Random(6)
    for _ in range(60):
        document = bpe.Document(known, wild(chance, 30))
        text = document.text
        for _ in range(12):
            start = chance.randint(0, len(text)) if chance.random() < 0.7 else len(text)
            stop = chance.randint(start, min(len(text), start + 9))
            new = wild(chance, chance.randint(0, 3))
            text = text[:start] + new + text[stop:]
            document.replace(start, stop, new)
            assert document.text == text and document.ids() == plain.encode_ordinary(text)
    long = bpe.Document(known, "some words here " * 5_000)
    assert long.replace(40_000, 40_001, "x") < 20 and long.append(" more") < 10


def test_odd_tables(spark, known, plain):
    texts = {1: None, 2: "", 3: "a <|endoftext|> b", 4: "é" * 5_000, 5: " ", 6: "tie", 7: "tie"}
    schema = "doc_id long, text string, ids string, decoded string, `__text` string"
    rows = [(i, t, "i", "d", "u") for i, t in texts.items()] * 2 + [(None, "no id", "i", "d", "u")]
    frame = bpe.decode(bpe.encode(spark.createDataFrame(rows, schema), *queries.byte_bpe()), *queries.byte_bpe())
    found = sorted((row.doc_id or 0, row.text or "", row.ids, bytes(row.decoded)) for row in frame.collect())
    assert found == sorted((i or 0, t or "", plain.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)
    assert bpe.encode(spark.createDataFrame([], schema), *queries.byte_bpe()).collect() == []
    odd = spark.createDataFrame([(1, None), (2, [64, None, 65])], "k int, ids array<int>")
    assert sorted((r.k, bytes(r.decoded)) for r in bpe.decode(odd, *queries.byte_bpe()).collect()) == [(1, b""), (2, b"ab")]


def test_query(spark, sf_dir, plain):
    rows = queries.QUERIES["op11_prefix_bpe"](spark, sf_dir).collect()
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = plain.encode_ordinary(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert row.decoded_sha256 == sha256(texts[row.doc_id].encode()).hexdigest()
