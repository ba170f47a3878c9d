"""Matrix BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gneiss.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.load_codec(bpe.default_ranks())


@pytest.fixture(scope="module")
def peer(codec):
    return tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_random_texts(codec, peer):
    r = random.Random(5)
    parts = ["a", "ab", " ", "\n", "  ", "é", "'s", "the ", "ing", "12", "中", "🙂", "\x1c", "\x85", "ا", "ß", "."]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 200))) for _ in range(200)]
    texts += ["", "x" * 5000, "ab" * 700, " " * 3000, "é" * 600, "thequickbrown" * 100]
    got = codec.encode(texts)
    assert [g.tolist() for g in got] == [peer.encode_ordinary(t) for t in texts]
    assert [codec.decode(g) for g in got] == [t.encode() for t in texts]


def test_every_code_point(codec, peer):
    texts = ["".join(map(chr, range(a, a + 128))) for a in range(0, 0x3000, 128)]
    assert [g.tolist() for g in codec.encode(texts)] == [peer.encode_ordinary(t) for t in texts]


def test_heap_and_matrix_agree(codec):
    words = [w * k for w in (b"abcab", b"the", b"\xff\x00", b"aa") for k in (3, 17, 60)]
    for w, ids in zip(words, codec.encode_words(words), strict=True):
        assert ids.tolist() == codec._heap(w).tolist()


def test_forgets(codec, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 0)
    assert codec.encode(["one two"])[0].tolist() == codec.encode(["one two"])[0].tolist()


def test_tables(spark, peer):
    df = spark.createDataFrame([(1, "one two", "x"), (1, "one two", "x"), (2, None, "x"), (3, "", None)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.round_trip(df).collect()}
    ids = peer.encode_ordinary("one two")
    assert got[1].n_tokens == len(ids) and got[1].ids_sha256 == hashlib.sha256(np.array(ids, "<u4")).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256(b"one two").hexdigest() and got[2].n_tokens == got[3].n_tokens == 0
    coded = bpe.encode_texts(df)
    assert bpe.round_trip(df).count() == coded.count() == 4
    assert {bytes(r.data) for r in bpe.decode_ids(coded).collect()} == {b"one two", b""}
    assert bpe.round_trip(df.limit(0)).count() == 0
