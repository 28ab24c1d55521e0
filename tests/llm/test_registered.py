"""Registered queries, whole: against their SQL, or a plain version."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from brute import without_repeats
from tokenizers import Tokenizer

from harborlog.llm import queries
from harborlog.llm.sql import ORACLES
from workload.compare import difference, duck

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {row.doc_id: row.text for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None


def test_shards(spark, sf_dir, texts):
    rows = queries.QUERIES["op1_feistel_shards"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    for shard in range(16):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(texts) // 16, -(-len(texts) // 16))


def test_packed(spark, sf_dir, texts):
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces: dict = {}
    sequences: dict = {}
    for r in queries.QUERIES["op4_packed_sequences"](spark, sf_dir).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, at = np.array([*encode.encode(text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for start, length, crc, total in sorted(pieces[i]):
            assert (start, total, crc) == (at, len(ids), zlib.crc32(ids[at : at + length].tobytes()))
            at += length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_repeated_passages(spark, sf_dir, texts):
    rows = queries.QUERIES["op7_repeated_passages"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == without_repeats(texts, 100)
