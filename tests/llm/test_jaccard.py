"""Components of near duplicates against brute force over all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gneiss.llm import jaccard, shingles
from gneiss.llm.components import connected_components


def brute(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, groups=6, each=25):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5)))
    passage = [word() for _ in range(40)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One  TWO"), (4, " \n"), (5, "one two three four five"), (6, "é É")]
    for g in range(groups):
        base = [word() for _ in range(60 + 20 * g)]
        for k in range(each):
            w = list(base)
            for _ in range(r.randint(0, 6)):
                w[r.randrange(len(w))] = word()
            if k % 5 == 0:
                w = w + passage
            if k % 9 == 0:
                w = w[: len(w) - r.randint(0, 25)]
            rows.append((100 + g * each + k, r.choice([" ", "\n", "\t "]).join(w)))
        rows += [(1000 + g * 3 + k, " ".join(base)) for k in range(3)]
    rows += [(2000 + k, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)])) for k in range(20)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed, monkeypatch):
    if seed == 2:  # common shingles, blocks and small meetings, as a large table has them
        monkeypatch.setattr(jaccard, "COMMON", 4)
        monkeypatch.setattr(jaccard, "HELD", 16)
        monkeypatch.setattr(jaccard, "SPAN", 64)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, token long, fp string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize(("held", "size"), [(16, 16 << 20), (2048, 4000), (2048, 16 << 20)])
def test_links(spark, held, size, monkeypatch):
    """Each row's number of links, copies included, whichever blocks its set is met in."""
    monkeypatch.setattr(jaccard, "HELD", held)
    monkeypatch.setattr(jaccard, "BYTES", size)
    rows = corpus(3, groups=4)
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for i, t in rows}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    want = {i: sum(1 for j, t in sets.items() if j != i and s and 100 * len(s & t) >= 75 * len(s | t)) for i, s in sets.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.n_links for r in jaccard.near_duplicates(df).collect()} == want and max(want.values()) > 15


def test_near_copies_of_mixed_lengths(spark):
    """2,000 near copies cut to mixed lengths: components and links against an inverted index over all shingles."""
    r = random.Random(9)
    base = [str(k) for k in range(160)]
    rows = []
    for k in range(2000):
        w = base[: r.randint(70, 160)]
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"x{r.randint(0, 10**9)}"
        rows.append((k, " ".join(w)))
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    often = Counter(t for own in sets for t in own)
    number = {t: k for k, t in enumerate(t for t, n in often.items() if n > 1)}
    matrix = np.zeros((len(rows), len(number)), np.float32)
    for k, own in enumerate(sets):
        matrix[k, [number[t] for t in own if t in number]] = 1
    both, n = (matrix @ matrix.T).astype(np.int64), np.array([len(own) for own in sets])
    np.fill_diagonal(both, 0)
    degree = (100 * both >= 75 * (n[:, None] + n - both)).sum(axis=1)
    got = {x.doc_id: x.n_links for x in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert [got[k] for k in range(len(rows))] == degree.tolist() and degree.max() > 500


def test_empty(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bounds():
    for n in range(1, 200):
        p = jaccard.prefix_size(n, 75)
        assert n - p + 1 >= 0.75 * n > n - p - 1e-9 - 1 + 0  # a partner may miss p - 1 of the prefix, not p
        for m in range(n, 200):
            need = jaccard.needed(n, m, 75)
            assert 100 * need >= 75 * (n + m - need) and 100 * (need - 1) < 75 * (n + m - need + 1)


def test_least_shared():
    """No pair of linked sizes shares fewer prefix shingles than the bound at the end of any block that holds it."""
    for n in range(1, 150):
        lo, hi = (int(x) for x in jaccard._reach(np.int64(n), 75))
        exact = {m: jaccard.needed(n, m, 75) - max(n - jaccard.prefix_size(n, 75), m - jaccard.prefix_size(m, 75)) for m in range(max(1, lo), hi + 1)}
        for a in exact:
            for b in range(a, hi + 1):
                least = min(jaccard._least_shared(n, a, 75), jaccard._least_shared(n, b, 75))
                assert least <= min(exact[m] for m in range(a, b + 1))


def test_block_least():
    r = np.random.default_rng(1)
    values = r.integers(-1000, 1000, 300)
    lo = r.integers(0, 300, 500)
    hi = np.array([r.integers(a + 1, 301) for a in lo])
    assert jaccard._block_least(values, lo, hi).tolist() == [values[a:b].min() for a, b in zip(lo, hi, strict=True)]


def test_derived_overlaps(monkeypatch):
    """Links, components and degrees of a block are the same from any number of bases."""
    r = np.random.default_rng(4)
    base = r.integers(0, 2**60, 80).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(80) > 0.1], r.integers(0, 2**60, r.integers(0, 12)).astype(np.uint64)])) for _ in range(40)]
    fps, every, none = np.arange(40), np.ones(40, bool), np.zeros(40, bool)
    both = np.array([[len(np.intersect1d(x, y)) for y in sets] for x in sets])
    n = np.array([len(x) for x in sets])
    link = (100 * both >= 75 * (n[:, None] + n - both)) & ~np.eye(40, dtype=bool)
    want = list(range(40))
    for a, b in zip(*np.nonzero(link), strict=True):
        want = [want[a] if u == want[b] else u for u in want]
    for bases in (1, 3, 64):
        monkeypatch.setattr(jaccard, "BASES", bases)
        found, degree = jaccard.link_sets(fps, sets, every, every, none, 75)
        up = list(range(40))
        for a, b, overlap in found:
            assert overlap == both[a, b] and link[a, b]
            up = [up[a] if u == up[b] else u for u in up]
        assert [up.index(u) for u in up] == [want.index(u) for u in want] and degree.tolist() == link.sum(axis=1).tolist()


def test_words_match_brute_force():
    texts = ["a b", "", None, "A\tb\x0bc\x1cd", "x" * 3, "é ü\u00a0w", "tail ", " lead"]
    data, offsets = shingles.text_buffer(pa.array(texts, pa.string()))
    starts, ends = shingles.word_bounds(data, offsets)
    raw = b"".join((t or "").encode() for t in texts)
    got = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
    assert got == [w for t in texts for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
    hashes = shingles.word_hashes(data, starts, ends)
    seen = {}
    for w, h in zip(got, hashes.tolist(), strict=True):
        assert seen.setdefault(w.lower(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_long_words(monkeypatch):
    monkeypatch.setattr(shingles, "_BLOCK", 16)
    text = pa.array(["a" * 100 + " " + "A" * 100 + " b " + "c" * 17 + "d", "b"])
    data, offsets = shingles.text_buffer(text)
    starts, ends = shingles.word_bounds(data, offsets)
    h = shingles.word_hashes(data, starts, ends)
    assert h[0] == h[1] and h[2] == h[4] and len(set(h.tolist())) == 3


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in list(up)}
