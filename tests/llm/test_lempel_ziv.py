from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from marketloom.llm import lempel_ziv
from marketloom.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm.rows import documents, frame, odd_texts, words
from tools.check_oracle import compare


def brute(rows, window):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(t[k : k + window]) for _, t in texts for k in range(len(t) - window + 1))
    out = []
    for i, t in texts:
        gone = set()
        for k in range(len(t) - window + 1):
            if seen[tuple(t[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(t), len(gone), b" ".join(w for k, w in enumerate(t) if k not in gone).decode()))
    return sorted(out, key=repr)


def removed(spark, rows, window, **kw):
    got = lempel_ziv.remove_repeats(documents(spark, rows), window, **kw)
    return sorted(map(tuple, got.collect()), key=repr)


def passages(seed, window, n=80):
    """Texts that share passages around the window's length, at different places and overlapping."""
    r = random.Random(seed)
    stock = [words(1000 + k, r.randrange(window // 2 + 1, 3 * window + 1), 50) for k in range(6)]
    out = []
    for i in range(n):
        text = []
        for _ in range(r.randrange(0, 4)):
            text += words(r.random(), r.randrange(0, window), 50)
            p = r.choice(stock)
            low = r.randrange(len(p))
            text += p[low : low + r.randrange(1, 2 * window + 1)]
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize("window,hot", [(1, 2048), (2, 1), (7, 1), (7, 2048), (35, 1), (35, 2048), (64, 2048)])
def test_equals_brute_force(spark, window, hot):
    rows = passages(window, window) + [(i, t) for i, t in passages(window, window)[:5]]
    rows += [(900, "a " * 150), (901, "a b " * 100), (902, "a b c d " * 60), (903, " ".join(f"own{k}" for k in range(90)))]
    got = removed(spark, rows, window, hot=hot)
    assert got == brute(rows, window)
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got)


def test_factors_are_the_longest_matches(monkeypatch):
    r = random.Random(5)
    parts = [np.array([r.randrange(3) for _ in range(r.randrange(4, 30))], np.uint64) for _ in range(12)]
    block = lempel_ziv.Block(parts)
    text = " ".join("".join("abc"[w] for w in p) for p in parts)

    def longest(at):
        end = text.find(" ", at) if " " in text[at:] else len(text)
        return max(n for n in range(end - at + 1) if n == 0 or any(text.startswith(text[at : at + n], k) for k in range(len(text)) if k != at))

    ends = {}
    for which, at, size in block.factors():
        for w, a, n in zip(which, at, size, strict=True):
            assert a == ends.get(w, block.starts[w])
            assert n == max(1, longest(int(a)))
            ends[w] = a + n
    assert [ends[w] for w in range(len(parts))] == block.ends.tolist()
    # Windows that cross a boundary are found too.
    for window in (2, 4, 6):
        found = block.repeats(window)
        inside = [k for s, e in zip(block.starts, block.ends, strict=True) for k in range(s, e - window + 1)]
        assert [bool(found[k]) for k in inside] == [longest(int(k)) >= window for k in inside]


def test_hot_passage_with_different_surroundings(spark):
    passage = " ".join(words(3, 50))
    rows = [(i, " ".join(words(100 + i, 20, 10**6)) + " " + passage + " " + " ".join(words(500 + i, 20, 10**6))) for i in range(60)]
    assert removed(spark, rows, 35, hot=10) == removed(spark, rows, 35) == brute(rows, 35)


def test_blocks_do_not_change_results(spark, monkeypatch):
    rows = passages(11, 20)
    monkeypatch.setattr(lempel_ziv, "BLOCK", 7)
    assert removed(spark, rows, 20) == brute(rows, 20)


def test_odd_rows(spark):
    rows = odd_texts() + [(20, odd_texts()[13][1] + " end", *odd_texts()[0][2:]), (21, "x" * 9 + " " + "y", *odd_texts()[0][2:])]
    got = sorted(map(tuple, lempel_ziv.remove_repeats(frame(spark, rows), 35).collect()), key=repr)
    assert got == brute([r[:2] for r in rows], 35)
    assert lempel_ziv.remove_repeats(frame(spark, [])).collect() == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert compare(QUERIES["op12_lempel_ziv"](spark, SMALL), con, ORACLE_SQL["op12_lempel_ziv"]) == ""
