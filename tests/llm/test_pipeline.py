from __future__ import annotations

from collections import Counter, defaultdict

import public_tokenizers

import corpus_pipeline as cp
from marketloom.llm.common import small_batches, stored
from marketloom.llm.packing import Encoder
from tests.llm.rows import documents, frame, words
from tests.llm.test_shingle_join import brute, copies


def corpus(spark):
    rows = [(i, t, "en", f"s{i % 4}") for i, t in copies(8, 3, 10)]
    rows += [(1000, "12345 !!", "en", "s1"), (1001, None, "en", "s2"), (1002, "words that are fine and stay", "en", "s3")]
    return documents(spark, rows)


def test_language_keeps_texts_with_letters(spark):
    kept = cp.in_a_known_language(spark, corpus(spark), "")
    assert {r.doc_id for r in kept.collect()} == {*range(30), 1002} and kept.columns == corpus(spark).columns
    unlabelled = frame(spark).withColumn("lang", cp.F.lit(None).cast("string"))
    assert cp.in_a_known_language(spark, unlabelled, "").count() == frame(spark).count()


def test_one_of_each_group_stays(spark):
    docs = corpus(spark)
    kept = cp.one_of_each_group(spark, docs, "").collect()
    want = {c for _, n, c in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert {r.doc_id for r in kept} == want and len(kept) == len(want) < 30


def test_near_copies_between_the_thresholds_go(spark):
    """Pairs of at least 0.8 on five words, but below 0.9 on three: new text appended, and isolated edits."""
    appended, scattered, far = (words(k, n, 4000) for k, n in ((31, 100), (32, 400), (33, 400)))
    edited = lambda text, n: [f"e{k}" if k % (400 // n) == 9 else w for k, w in enumerate(text)]
    texts = [appended, appended + words(34, 15, 4000), scattered, edited(scattered, 8), far, edited(far, 16)]
    rows = [(k, " ".join(t), "en", "a") for k, t in enumerate(texts)]
    assert [c for _, _, c in brute([r[:2] for r in rows])] == [0, 1, 2, 3, 4, 5]
    assert [c for _, _, c in brute([r[:2] for r in rows], 80, 100, 5)] == [0, 0, 2, 2, 4, 5]
    assert {r.doc_id for r in cp.one_of_each_group(spark, documents(spark, rows), "").collect()} == {0, 2, 4, 5}


def test_repeated_ids_and_nulls(spark):
    kept = cp.one_of_each_group(spark, frame(spark), "")
    assert kept.columns == frame(spark).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[None] == 2 and ids[11] == ids[12] == 1 and ids[2] == ids[4] == ids[9] == 0


def test_whole_run(spark):
    docs = corpus(spark)
    for _, stage in cp.STAGES[:-1]:
        new = stored(stage(spark, docs, ""))
        assert new.columns == docs.columns
        docs = new
    texts = {r.doc_id: r.text for r in docs.collect()}
    tokens, sequences = defaultdict(int), defaultdict(int)
    for r in cp.as_sequences(spark, docs, "").collect():
        tokens[r.doc_id] += r.length
        sequences[r.sequence_id] += r.length
    encode = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokens == {i: len(encode(t)) + 1 for i, t in texts.items()} and max(sequences.values()) <= 1024


def test_empty_table(spark):
    docs = frame(spark, [])
    for _, stage in cp.STAGES:
        docs = stored(stage(spark, docs, ""))
    assert docs.collect() == []


def test_texts_reach_python_in_small_batches(spark):
    """Whole partitions as one batch took an executor's memory; a limit that the session has is kept."""
    own, docs = spark.newSession(), [(k, "x" * 100_000, "en", "a") for k in range(100)]
    sizes = lambda session: documents(session, docs).coalesce(1).select("text").mapInArrow(lambda bs: (b.from_pydict({"n": [len(b)]}) for b in bs), "n long").collect()
    assert [r.n for r in sizes(own)] == [100]
    small_batches(own)
    assert max(r.n for r in sizes(own)) < 60
    other = spark.newSession()
    other.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    small_batches(other)
    assert other.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"
