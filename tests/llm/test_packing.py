"""Best-two-fit packing: whole pieces, gapless places, and few sequences."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gneiss.llm import packing


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)] and packing.cut(1, 4) == [(0, 1)]


def test_one_at_a_time():
    """Patterns with multiplicities are what packing bin after bin gives."""

    def plain(lengths, size):
        left, bins = sorted(lengths), []
        while left:
            own, gap = [], size
            while fit := [n for n in left if n <= gap]:
                own.append(fit[-1])
                left.remove(fit[-1])
                gap -= fit[-1]
            if gap and own:
                small, room = own[-1], gap + own[-1]
                sums = [(left[i] + left[j]) for i in range(len(left)) for j in range(i) if small < left[i] + left[j] <= room]
                if sums:
                    best = max(sums)
                    a, b = next((a, b) for k, a in enumerate(left) for b in left[k + 1 :] if a + b == best)
                    left.remove(a)
                    left.remove(b)
                    own = own[:-1] + [a, b]
                    left.append(small)
                    left.sort()
            bins.append(sum(own))
        return bins

    r = random.Random(3)
    for _ in range(60):
        lengths = [r.randint(1, 30) for _ in range(r.randint(0, 40))]
        counts = {n: lengths.count(n) for n in lengths}
        mine = [sum(own) for own, times in packing.best_two_fit(counts, 30) for _ in range(times)]
        assert sorted(mine) == sorted(plain(lengths, 30))


def test_assign():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 1025, 5000)
    bins, offsets = packing.assign(lengths, 1024)
    for b in range(bins.max() + 1):
        at = np.flatnonzero(bins == b)
        at = at[np.argsort(offsets[at])]
        assert offsets[at].tolist() == np.concatenate([[0], np.cumsum(lengths[at])[:-1]]).tolist()
        assert lengths[at].sum() <= 1024
    assert bins.max() + 1 <= 1.01 * -(-lengths.sum() // 1024)


def test_encoder():
    """The fast path gives what the tokenizers library gives."""
    path = packing.default_tokenizer()
    encode, slow = packing.load_encoder(path), Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    texts = ["", " a  b\n\n c", "<|endoftext|>x", "naïve Straße 12 345's", "中文 text", "\x85\xa0\u1680x \u200b", *[f"a{chr(c)}{chr(c)} {chr(c)}1" for c in range(0x250)]]
    assert all(encode(t).tolist() == slow.encode(t, add_special_tokens=False).ids for t in texts)
    assert path == public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("group_rows", [1 << 17, 3])
def test_documents(spark, group_rows):
    long = " ".join(f"w{k}" for k in range(2000))
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "a few words here", 9), (3, "a few words here", 9), (4, long, 9)], "doc_id long, text string, sequence_id int")
    got = packing.pack_documents(df, with_ids=True, group_rows=group_rows).toPandas()
    assert (got.groupby("sequence_id").length.sum() <= 1024).all()
    encode = packing.load_encoder(packing.default_tokenizer())
    for doc, text in ((1, ""), (2, ""), (4, long)):
        own = got[got.doc_id == doc].sort_values("piece")
        ids = [int(x) for part in own.ids for x in part]
        assert ids == [*encode(text).tolist(), 2]
        assert own.start.tolist() == np.concatenate([[0], np.cumsum(own.length)[:-1]]).tolist() and (own.length.iloc[1:] == 1024).all()
    assert len(got[got.doc_id == 3]) == 2
    assert all(zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32 for r in got.itertuples())
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == np.concatenate([[0], np.cumsum(own.length)[:-1]]).tolist()


def test_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
