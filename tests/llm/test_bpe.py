"""Byte-level BPE against the tokenizer library."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from shardloom.llm import byte_bpe as B
from shardloom.llm.catalog import LLM_QUERIES, vocabulary

from ..conftest import SF_MID
from .conftest import ROWS


@pytest.fixture(scope="module")
def plain():
    data, pattern = vocabulary()
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=B.load_ranks(data), special_tokens={}).encode_ordinary


def digests(text, plain):
    ids = plain(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark, plain):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = LLM_QUERIES["op7_byte_bpe"](spark, SF_MID).collect()
    assert len(rows) == len(docs)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(docs[r.doc_id], plain) for r in rows)


def test_odd_rows_in_many_blocks(spark, odd_docs, no_docs, plain):
    rows = B.encode(odd_docs, *vocabulary(), whole=True, block_bytes=1 << 16).collect()
    assert len(rows) == len(ROWS)
    want = sorted((str(r[0]), *digests(r[1], plain)) for r in ROWS)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    text = {str(r[0]): r[1] or "" for r in ROWS if r[0] is not None}
    for r in rows:
        if r.doc_id is not None:
            assert bytes(r.decoded).decode() == text[str(r.doc_id)] and r.ids == plain(text[str(r.doc_id)])
    assert B.encode(no_docs, *vocabulary()).count() == 0


def test_pretokens_of_any_characters(plain):
    rng = random.Random(3)
    split = B.splitter(vocabulary()[1])
    chars = [chr(c) for c in range(0x260)] + list("̀ 　東\U0001f600١ ​﻿᠎")
    for _ in range(4000):
        wide = rng.choice([0x250, len(chars)])
        text = "".join(rng.choice(chars[:wide]) if rng.random() < 0.7 else rng.choice(" \t\n'stremdvl 1a") for _ in range(rng.randint(0, 14)))
        assert "".join(split(text)) == text
        assert [i for w in split(text) for i in plain(w)] == plain(text)


def test_ids_without_the_decoded_text(spark, odd_docs, plain):
    """The decoded texts of a block are not gathered for a caller that does not want them."""
    got = B.encode(odd_docs, *vocabulary(), whole=True, decoded=False, block_bytes=1 << 16)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    want = sorted((str(r[0]), plain(r[1] or "")) for r in ROWS)
    assert sorted((str(r.doc_id), r.ids) for r in got.collect()) == want
