from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from marketloom.llm import language_id as li
from marketloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.rows import documents, frame

TEXTS = {
    "en": "the quick brown fox jumps over the lazy dog while the others watch from the hill and think about the weather",
    "de": "der schnelle braune fuchs springt über den faulen hund und die anderen schauen vom hügel aus zu während es regnet",
    "es": "el rápido zorro marrón salta sobre el perro perezoso mientras los demás miran desde la colina y piensan en la lluvia",
}


def labelled(spark, n=30):
    r = random.Random(1)
    rows = []
    for k in range(n):
        for lang, text in TEXTS.items():
            w = text.split()
            r.shuffle(w)
            rows.append((len(rows), " ".join(w), lang))
    return documents(spark, rows)


def test_counts_equal_brute_force():
    for text in ("Hello, wörld!! 12", "a", "İxß--", "", "1 2", "日本 語"):
        letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
        line = f" {' '.join(letters.split())} "
        want = Counter()
        for n in range(1, li.ORDER + 1):
            want.update(line[k : k + n] for k in range(len(line) - n + 1))
        del want[" "]
        grams, counts = li.ngram_counts(text)
        numbers = Counter()
        for gram, n in want.items():
            number = 0
            for c in gram:
                number = number << 21 | (0 if c == " " else ord(c))
            numbers[number] += n
        assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == (numbers if line.strip() else {})


def test_long_texts_are_counted_whole(monkeypatch):
    text = " ".join(TEXTS.values()) * 5
    want = li.ngram_counts(text)
    monkeypatch.setattr(li, "STRETCH", 17)
    got = li.ngram_counts(text)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_distance_equals_brute_force():
    ranked = {k: li._top(*li.ngram_counts(t)).tolist() for k, t in TEXTS.items()}
    profiles = li.Profiles(ranked)
    own = li._top(*li.ngram_counts("the dog und der fox")).tolist()
    apart = {k: sum(abs(g.index(x) - r) if x in g else li.PROFILE for r, x in enumerate(own)) for k, g in ranked.items()}
    best = min(sorted(apart), key=apart.get)
    lang, score = profiles.predict("the dog und der fox")
    assert lang == best and np.isclose(score, 1 - apart[best] / (len(own) * li.PROFILE))


def test_held_out_accuracy(spark):
    rows = QUERIES["op7_language_id"](spark, SMALL).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    profiles = li.fit(labelled(spark))
    assert profiles.languages == ["de", "en", "es"]
    table = frame(spark).withColumn("lang_pred", li.F.lit("old"))
    out = li.identify(table, profiles)
    assert sorted(out.columns) == sorted(table.columns)
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert got[5] == got[6] == got[7] == got[10] == ("und", 0.0)
    assert got[14][0] in profiles.languages and out.count() == table.count()


def test_nothing_learned(spark):
    profiles = li.fit(frame(spark, []))
    assert profiles.predict("some text") == ("und", 0.0)
    assert li.identify(frame(spark, []), profiles).collect() == []


@pytest.mark.parametrize("share,rows", [(1e-7, 300_000_000), (0.25, 100_000), (1.0, 1000), (0.0, 1000)])
def test_a_share_draws_its_part_of_the_rows(spark, share, rows):
    """Also where it is far below one in a million."""
    found = spark.range(rows, numPartitions=8).where(li.drawn("id", share)).count()
    assert abs(found - share * rows) <= 5 * (share * (1 - share) * rows) ** 0.5
