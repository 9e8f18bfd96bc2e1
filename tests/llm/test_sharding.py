from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import duckdb
import pytest

from marketloom.llm import sharding
from marketloom.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm.rows import frame, words
from tools.check_oracle import compare


def brute(rows, limit):
    """Shard of each row, splitting one bucket at a time."""
    own = []
    for i, text in rows:
        data = (text or "").encode()
        key = f"{'' if i is None else i}/{hashlib.md5(data).hexdigest()}"
        own.append((i, int(hashlib.md5(key.encode()).hexdigest()[:15], 16), len(data)))
    total = sum(r[2] for r in own)
    start = max(0, math.ceil(math.log2(max(1, total / limit))))
    todo = defaultdict(list)
    for r in own:
        todo[f"{r[1]:060b}"[:start]].append(r)
    out = []
    while todo:
        bits, held = todo.popitem()
        size = sum(r[2] for r in held)
        if size <= limit or len({r[1] for r in held}) == 1:
            out += [(*r, bits, len(bits), size, size > limit) for r in held]
        else:
            for r in held:
                todo[f"{r[1]:060b}"[: len(bits) + 1]].append(r)
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [100, 3000, 10**9])
def test_equals_brute_force(spark, limit):
    rows = [(k, " ".join(words(k, 3 + k % 60))) for k in range(200)] + [(500, "long " * 300), (501, "long " * 400)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), limit)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, limit)


def test_deeper_than_the_summed_prefixes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FINE", 1)
    rows = [(k, "x" * (40 if k % 9 else 2000)) for k in range(120)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 2010)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 2010)
    assert max(r.depth for r in got.collect()) > 6


def test_odd_rows(spark):
    table = frame(spark)
    got = sharding.shard(table, 5000).collect()
    assert sorted(map(tuple, got), key=repr) == brute([(r.doc_id, r.text) for r in table.collect()], 5000)
    assert [r.oversized for r in got if r.doc_id == 15] == [True]


def test_empty_table(spark):
    assert sharding.shard(frame(spark, []), 100).collect() == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert compare(QUERIES["op3_sharding"](spark, SMALL), con, ORACLE_SQL["op3_sharding"]) == ""
