from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import angular_negatives as an
from marketloom.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tools.check_oracle import compare

SCHEMA = "vec_id long, label int, embedding array<float>, block string, score long, uid string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA)


def brute(rows):
    parts = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if sum(x * x for x in whole) < 2**62:
            parts[(i, label, whole)] = None
    out = []
    for i, label, v in parts:
        if i % 10:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), j, other == label) for j, other, w in parts if j != i and len(w) == len(v)))
        for p, j, _ in [s for s in scored if s[2]][:5]:
            fit = [(n, k) for n, k, same in scored if not same and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(i, j, place, k, -p, -n) for place, (n, k) in enumerate(fit[:10], 1)]
    return sorted(out)


def mined(spark, rows):
    return sorted(map(tuple, an.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()))


def clustered(seed, n, dim, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dim))
    v = centres[r.integers(0, 5, n)] + spread * r.normal(size=(n, dim))
    v *= r.uniform(0.2, 2, (n, 1))
    return [(i, int(r.integers(0, 3)), v[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("spread,block,asked", [(0.05, 4096, 256), (0.05, 16, 4), (1.0, 16, 4)])
def test_equals_brute_force(spark, monkeypatch, spread, block, asked):
    monkeypatch.setattr(an, "BLOCK_ROWS", block)
    monkeypatch.setattr(an, "ANCHOR_ROWS", asked)
    monkeypatch.setattr(an, "GRID", 3)
    rows = clustered(1, 300, 12, spread)
    got = mined(spark, rows)
    assert got == brute(rows)
    assert got


def test_ties_copies_and_lengths(spark):
    same = [0.5, 0.25, 1.0]
    rows = [(i, i % 2, same) for i in range(30)] + [(100 + i, 0, [0.5, 0.1 * i]) for i in range(12)] + [(120 + i, 1, [0.3, 0.1 * i]) for i in range(12)]
    rows += [(200, 0, []), (201, 0, []), (202, 1, []), (40, 0, same), (40, 0, same), (210, 1, [0.0] * 3), (220, 2, [-0.5, -0.25, -1.0])]
    got = mined(spark, rows)
    assert got == brute(rows)
    assert any(r[0] == 200 and r[4] == r[5] == 0 for r in got)


def test_rows_that_take_no_part(spark):
    rows = clustered(3, 60, 4, 0.3)
    odd = [(None, 1, [1.0] * 4), (61, None, [1.0] * 4), (62, 1, None), (63, 1, [1.0, None, 1.0, 1.0]), (64, 1, [float("nan")] * 4), (70, 1, [float("inf"), 0.0, 0.0, 0.0]), (80, 1, [1e20, 0.0, 0.0, 0.0])]
    assert mined(spark, rows + odd) == mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, odd) == []


def test_long_vectors_are_scored_in_whole_numbers(spark):
    rows = [(i, i % 2, [3e5 + i, -2e5, 1e5 * (i % 3)]) for i in range(40)]
    assert mined(spark, rows) == brute(rows)


def test_bounds_hold_every_score():
    r = np.random.default_rng(4)
    v = np.floor(256 * r.normal(size=(400, 8))).astype("<i4")
    v[:40] = v[0] * np.arange(1, 41)[:, None]
    angles = an.angles(v, v[:5])
    norms = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    side = an.Side({"size": 400, "dim": 8, "uids": np.arange(400).tobytes(), "ids": np.arange(400).tobytes(), "labels": np.zeros(400, "<i4").tobytes(), "vectors": v.tobytes(), "norms": norms.tobytes(), "angles": angles.tobytes(), "limits": b""})
    exact = v.astype(np.int64) @ v.astype(np.int64).T
    for a in range(400):
        low, high = side.bounds(norms[a], angles[a], np.arange(400))
        assert (low <= exact[a]).all() and (exact[a] <= high).all()
        if a < 5:  # at a reference direction the bounds are close
            assert (high - low).max() < 1e-3 * norms[a] * norms.max() + 4


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    verdict = compare(QUERIES["op13_angular_negatives"](spark, SMALL), con, ORACLE_SQL["op13_angular_negatives"])
    assert verdict == "" or verdict.startswith("EMPTY")
