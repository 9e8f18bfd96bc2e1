from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest

import marketloom.llm.shingle_join as sj
from tests.llm.rows import documents, frame, words


def brute(rows, num=90, den=100, width=3):
    """Set size and component of each row, from plain sets of strings."""
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    def shingles(text):
        w = (text or "").encode().lower().split()
        return {b" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and den * len(a & b) >= num * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def copies(seed, families, size):
    r = random.Random(seed)
    out = []
    for family in range(families):
        base = words(100 + family, r.choice([12, 40, 120, 300]), 4000)
        for k in range(size):
            text = list(base)
            for _ in range(r.randrange(6)):
                text[r.randrange(len(text))] = f"e{r.randrange(10**6)}"
            out.append(" ".join(text[: -r.randrange(1, 6)] if k % 5 == 0 else text))
    r.shuffle(out)
    return list(enumerate(out))


def got(frame_):
    return sorted(map(tuple, frame_.collect()), key=repr)


@pytest.mark.parametrize("chunk", [96, 5])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(sj, "CHUNK", chunk)  # the small one takes the way of large families
    rows = copies(3, 6, 24)
    assert got(sj.jaccard_components(documents(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    table = frame(spark)
    assert got(sj.jaccard_components(table)) == brute([(r.doc_id, r.text) for r in table.collect()])


def test_empty_table(spark):
    assert sj.jaccard_components(frame(spark, [])).collect() == []


@pytest.mark.parametrize("similarity", [Fraction(9, 10), Fraction(4, 5)])
def test_linking_sets_share_a_prefix_shingle(similarity):
    """Any two sets at the threshold have a prefix shingle in common, whichever shingles come last."""
    rng = np.random.default_rng(4)
    found = 0
    for n in (1, 5, 9, 20, 63, 64, 100, 333, 2000):
        for turn in range(40):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            gone = rng.integers(0, max(1, int(n * (1 - similarity))) + 1)
            more = rng.integers(0, max(1, int(n * (1 - similarity))) + 1)
            b = np.unique(np.concatenate((rng.permutation(a)[: n - gone], rng.integers(0, 2**63, more).astype(np.uint64))))
            overlap = len(np.intersect1d(a, b))
            if not len(b) or overlap < similarity * (len(a) + len(b) - overlap):
                continue
            common = np.sort(rng.permutation(a)[: [0, n // 2, n][turn % 3]])
            rank = rng.permutation(len(common))
            found += 1
            assert len(np.intersect1d(sj.prefix(a, similarity, common, rank), sj.prefix(b, similarity, common, rank)))
    assert found > 100


def families(spark, monkeypatch, rows, similarity, width):
    """Sizes of the candidate families, from the documents that meet."""
    seen = {}

    def components(edges):
        found = original(edges)
        if not seen:
            seen["sizes"] = sorted((r["count"] + 1 for r in found.groupBy("component").count().collect()), reverse=True)
        return found

    original = sj.components
    monkeypatch.setattr(sj, "components", components)
    out = got(sj.jaccard_components(documents(spark, rows), similarity, width))
    return out, seen["sizes"]


def test_unrelated_texts_share_no_family(spark, monkeypatch):
    rows = [(k, " ".join(words(k, r, 4000))) for k, r in enumerate([300] * 40 + [1000] * 20 + [5000] * 6)]
    out, sizes = families(spark, monkeypatch, rows, Fraction(4, 5), 5)
    assert sizes == []
    assert sorted(r[2] for r in out) == list(range(66))


def test_a_shared_passage_makes_no_family(spark, monkeypatch):
    passage = " ".join(words(77, 60, 4000))
    rows = [(k, " ".join(words(k, 150, 4000)) + " " + passage + " " + " ".join(words(1000 + k, 150, 4000))) for k in range(300)]
    out, sizes = families(spark, monkeypatch, rows, Fraction(4, 5), 5)
    assert sizes == []
    assert sorted(r[2] for r in out) == list(range(300))


@pytest.mark.parametrize("common,meet", [(1 << 16, 128), (0, 3)])
def test_four_fifths_of_five_words_equals_brute_force(spark, monkeypatch, common, meet):
    monkeypatch.setattr(sj, "CHUNK", 7)
    monkeypatch.setattr(sj, "COMMON", common)
    monkeypatch.setattr(sj, "MEET", meet)
    rows = copies(9, 6, 24)
    # A copy with new text appended, and one with single words changed all over.
    base = " ".join(words(5, 400, 10**6))
    rows += [(900, base), (901, base + " " + " ".join(words(6, 60, 10**6))), (902, " ".join("new" if k % 50 == 7 else w for k, w in enumerate(base.split())))]
    found = got(sj.jaccard_components(documents(spark, rows), Fraction(4, 5), 5))
    assert found == brute(rows, 80, 100, 5)
    assert [r[2] for r in found if r[0] in (900, 901, 902)] == [900] * 3


def test_tree_loses_no_pair():
    rng = np.random.default_rng(5)
    points = rng.poisson(3, (90, sj.DIMS))
    weights = 9 * points.sum(axis=1)
    tree = sj.Tree(points, weights, 19)
    for p, w in zip(points, weights, strict=True):
        near = set(tree.near(p, w).tolist())
        assert {k for k in range(90) if np.minimum(points[k], p).sum() * 19 >= w + weights[k]} == near
