from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from marketloom.llm import permuterm
from marketloom.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm.rows import frame, odd_texts
from tools.check_oracle import compare


def brute_words(rows, least_chars=6, least_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_chars:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_groups(counts, factor=5):
    form = {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(out, key=repr)


def grouped(spark, counts, **kw):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, permuterm.spelling_groups(rows, **kw).collect()), key=repr)


@pytest.mark.parametrize("alphabet,seed", [("ab", 1), ("aß語", 2), ("abcdefgh", 3)])
def test_equals_brute_force(spark, alphabet, seed):
    r = random.Random(seed)
    counts = {"".join(r.choice(alphabet) for _ in range(r.randrange(0, 7))): 5 ** r.randrange(0, 5) + r.randrange(3) for _ in range(150)}
    got = grouped(spark, counts)
    assert got == brute_groups(counts)


def test_runs_of_one_character_count_once(spark):
    counts = {"aaaa": 1, "aaa": 30, "aaaaa": 2, "baaa": 7}
    assert grouped(spark, counts) == brute_groups(counts)


def test_chain_is_followed_to_its_end(spark):
    counts = {"abcdef"[:k] + "x" * (8 - k): 5**k for k in range(7)}
    got = grouped(spark, counts)
    assert got == brute_groups(counts)
    assert {row[5] for row in got} == {"abcdefxx"}


def test_ties_go_to_the_smaller_word(spark):
    assert [r[3] for r in grouped(spark, {"cat": 1, "hat": 9, "bat": 9, "rat": 9}) if r[0] == "cat"] == ["bat"]


def test_words_of_odd_texts(spark):
    rows = odd_texts() + [(k, "Straße STRASSE ÀÉ× naïveté words-with_signs x" * 3, *odd_texts()[0][2:]) for k in range(500, 900)]
    got = permuterm.corpus_words(frame(spark, rows))
    counts = brute_words([r[:2] for r in rows])
    assert dict(map(tuple, got.collect())) == counts
    assert any(w in counts for w in ("strasse", "straße"))
    out = permuterm.spelling_groups(got)
    assert sorted(map(tuple, out.collect()), key=repr) == brute_groups(counts)


def test_empty_and_odd_tables(spark):
    assert permuterm.spelling_groups(permuterm.corpus_words(frame(spark, []))).collect() == []
    rows = spark.createDataFrame([(None, 3, "x"), ("a\u0000b", 4, "x"), ("ab", 5, "x"), ("", 2, "x"), ("a", 1, "x")], "word string, n long, prefix string")
    got = sorted(map(tuple, permuterm.spelling_groups(rows).collect()))
    assert got == [("", 2, 1, None, None, ""), ("a", 1, 2, "ab", 5, "ab"), ("a\u0000b", 4, 0, None, None, "a\u0000b"), ("ab", 5, 1, None, None, "ab")]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert compare(QUERIES["op11_permuterm"](spark, SMALL), con, ORACLE_SQL["op11_permuterm"]) == ""
