from __future__ import annotations

import numpy as np
import pytest

import marketloom.llm.cap_filters as cf

SCHEMA = "vec_id long, embedding array<float>, label int, node long, print string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 3, "p") for i, v in rows], SCHEMA)


def brute(rows, similarity=0.95):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and len(v)]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    links = {i: 0 for i, _ in rows}
    label = {i: i for i, _ in rows}
    pairs = []
    for k, (i, a) in enumerate(usable):
        for j, b in usable[:k]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= similarity:
                links[i], links[j] = links[i] + 1, links[j] + 1
                pairs.append((i, j))
    for _ in rows:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return sorted((i, links[i], label[i], i == label[i]) for i, _ in rows)


@pytest.mark.parametrize("chunk", [256, 8])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(cf, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(12):
        center = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 30))):
            rows.append(center + rng.standard_normal(64) * rng.choice([0.05, 0.15, 0.22]))
    rows += rows[:20] + [v * 2 for v in rows[20:25]]
    rows = [(k, v.tolist()) for k, v in enumerate(rows)]
    got = sorted(map(tuple, cf.near_duplicates(table(spark, rows)).collect()))
    want = brute(rows)
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert found >= 0.99 * true and true > 500
    assert sum(g[2:] == w[2:] for g, w in zip(got, want, strict=True)) >= 0.99 * len(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 2]), (2, [1, 2]), (3, [2, 4]), (4, None), (5, []), (6, [0, 0]), (7, [1, None]), (8, [nan, 1]), (9, [inf, 1]), (10, [1, 2, 0]), (11, [-1, -2])]
    assert sorted(map(tuple, cf.near_duplicates(table(spark, rows)).collect())) == brute(rows)
    out = cf.near_duplicates(table(spark, [(None, [1, 2]), (1, [1, 2]), (1, [1, 2])])).collect()
    assert sorted(map(tuple, out), key=repr) == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]


def test_vectors_that_share_their_smallest_id(spark):
    """No class is lost: each vector that id 1 holds keeps its copies and near copies."""
    vectors = [[1, 0, 0], [0, 1, 0], [0, 0, 1]]
    rows = [(1, v) for v in vectors] + [(10 * k + j, v) for k, v in enumerate(vectors, 1) for j in (1, 2)] + [(50, [0, 1, 0.01])]
    out = sorted(map(tuple, cf.near_duplicates(table(spark, rows)).collect()))
    links = {11: 2, 12: 2, 21: 3, 22: 3, 31: 2, 32: 2, 50: 3}
    assert out == [(1, 2, 1, True), (1, 2, 1, True), (1, 3, 1, True)] + [(i, n, 1, False) for i, n in links.items()]


def test_empty_table(spark):
    assert cf.near_duplicates(table(spark, [])).collect() == []


def test_recall_at_the_threshold():
    code = cf.Code(32, 5000, 0.95)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((400, 32))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert np.mean(met) >= 0.95
