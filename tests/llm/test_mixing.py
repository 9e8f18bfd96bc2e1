from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm import mixing
from marketloom.llm.common import small_table
from tests.llm.rows import documents, frame, words


def test_targets():
    assert mixing.targets([100, 100], [1, 1]) == [150, 150]
    assert mixing.targets([10, 1000, 1000], [5, 2, 1]) == pytest.approx([20, 2995 * 2 / 3, 2995 / 3])
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([200, 250 * 2 / 3, 250 / 3])
    assert mixing.targets([0, 10], [5, 2]) == [0, 15]
    assert mixing.targets([], []) == []


def test_permutation_is_one():
    for size in (1, 2, 3, 64, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(size), size, 77)) == list(range(size))
    assert (mixing.permuted(np.arange(1000), 1000, 1) != mixing.permuted(np.arange(1000), 1000, 2)).any()


def test_shards_take_the_targets_together():
    slots = np.array([5000, 0, 123, 40_000])
    shards = -(-int(slots.sum()) // mixing.SLOTS)
    total = np.zeros(4, int)
    for shard in range(shards):
        before, own = mixing.shard_counts(slots, shard, 3)
        assert (before == total).all() and own.sum() == min(mixing.SLOTS, slots.sum() - shard * mixing.SLOTS)
        total += own
    assert (total == slots).all()


def test_very_many_slots():
    slots = np.array([3 * 10**12, 5 * 10**11 + 1])
    before, own = mixing.shard_counts(slots, 10**9, 3)
    assert own.sum() == mixing.SLOTS and before.sum() == 10**9 * mixing.SLOTS
    assert before[0] / before.sum() == pytest.approx(6 / 7, rel=1e-3)


def rows(spark):
    return documents(spark, [(k, " ".join(words(k, 40 + 13 * (k % 40))), "en", f"s{k % 3}") for k in range(150)])


def test_taken_words(spark):
    docs = rows(spark)
    got = mixing.taken_words(mixing.mix(docs)).collect()
    again = mixing.taken_words(mixing.mix(docs.repartition(5))).collect()
    assert sorted(got) == sorted(again) and len(got) == 150
    sizes = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    taken, goal = Counter(), {}
    for r in got:
        assert r.size == sizes[r.doc_id] and 0 <= r.taken <= 2 * r.size
        taken[r.doc_id % 3] += r.taken
        goal[r.doc_id % 3] = r.target
    assert sum(goal.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - goal[s]) <= mixing.BLOCK for s in goal)


def test_slots_form_whole_shards(spark):
    mixture = mixing.mix(rows(spark))
    slots = mixture.slots.collect()
    by_shard = Counter(r.shard for r in slots)
    assert len({(r.shard, r.slot) for r in slots}) == len(slots) == sum(s.slots for s in mixture.sources)
    assert sorted(by_shard.values())[1:] == [mixing.SLOTS] * (len(by_shard) - 1)
    assert max(Counter((r.source_no, r.pass_no, r.block) for r in slots).values()) == 1


def test_mixed_documents_hold_the_taken_words(spark):
    docs = rows(spark)
    taken = {r.doc_id: r.taken for r in mixing.taken_words(mixing.mix(docs.withColumn("_text_key", mixing.F.xxhash64("text")), keep=("doc_id", "_text_key"))).collect()}
    old = {r.doc_id: r.text for r in docs.collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    new = {r.doc_id: r for r in out.collect()}
    assert {k: n for k, n in taken.items() if n} == {k: len(r.text.split()) for k, r in new.items()}
    for k, r in new.items():
        assert r.n_chars == len(r.text) and not Counter(r.text.split()) - Counter(old[k].split() * 2)
        if taken[k] == len(old[k].split()) and r.text.split()[0] == old[k].split()[0]:
            assert r.text == old[k] or "\n" in r.text


def test_odd_rows(spark):
    table = frame(spark)
    got = mixing.taken_words(mixing.mix(table)).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), len((r.text or "").encode().split())) for r in table.collect())
    assert all(r.taken <= 2 * r.size for r in got)
    assert mixing.mixed_documents(table).columns == table.columns and mixing.mixed_documents(table).count() > 5


def test_empty_table(spark):
    assert mixing.taken_words(mixing.mix(frame(spark, []))).collect() == []
    assert mixing.mixed_documents(frame(spark, [])).collect() == []


def test_texts_are_cut_in_small_batches():
    rows = pa.RecordBatch.from_pylist([{"text": f"a{k} b", "parts": [{"pass_no": 0, "start": 0, "length": 2}]} for k in range(2 * mixing.ROWS + 1)])
    out = list(mixing._cut(["text"], 0)([rows]))
    assert [len(b) for b in out] == [mixing.ROWS, mixing.ROWS, 1]
    assert [t for b in out for t in b.column(0).to_pylist()] == rows.column(0).to_pylist()


def test_table_of_the_driver_needs_no_python_workers(spark):
    table = small_table(spark, "source string, source_no int", [("a", 0), (None, 1)])
    assert sorted(map(tuple, table.collect()), key=lambda r: r[1]) == [("a", 0), (None, 1)]
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()
    assert small_table(spark, "source string, source_no int", []).count() == 0
