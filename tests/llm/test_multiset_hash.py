from __future__ import annotations

import hashlib
import random

import pytest

from marketloom.llm import multiset_hash as mh
from tests.llm.rows import documents, frame, words


def text_of(seed, lines):
    return "\n".join(" ".join(words(seed * 1000 + k, 6)) for k in range(lines))


def test_order_does_not_matter():
    lines = text_of(1, 30).split("\n")
    other = list(lines)
    random.Random(1).shuffle(other)
    assert mh.fingerprint("\n".join(lines)) == mh.fingerprint("\n".join(other))
    assert mh.fingerprint("\n".join(lines)) != mh.fingerprint("\n".join(lines[:-1] + lines[:1]))


def test_insertion_and_deletion():
    whole, part, rest = text_of(2, 9), "\n".join(text_of(2, 9).split("\n")[:4]), "\n".join(text_of(2, 9).split("\n")[4:])
    assert mh.add(mh.fingerprint(part), mh.fingerprint(rest)) == mh.fingerprint(whole)
    assert mh.add(mh.fingerprint(whole), mh.fingerprint(rest), -1) == mh.fingerprint(part)
    assert mh.fingerprint("") == bytes(mh.WIDTH)


@pytest.mark.parametrize("common", [0, 20, 40])
def test_likeness_is_near_the_share_in_common(common):
    a = text_of(3, common).split("\n") * bool(common) + text_of(4, 40 - common).split("\n") * (common < 40)
    b = text_of(3, common).split("\n") * bool(common) + text_of(5, 40 - common).split("\n") * (common < 40)
    got = mh.likeness(mh.fingerprint("\n".join(a)), mh.fingerprint("\n".join(b)))
    assert got == pytest.approx(common / 40, abs=0.2)


def test_long_lines_are_cut_by_content():
    line = " ".join(words(6, 400))
    parts = mh.paragraphs(line)
    assert b" ".join(parts).decode() == line and 20 < len(parts) < 200
    moved = mh.paragraphs("new words before " + line)
    assert len(set(parts) & set(moved)) >= len(parts) - 2


@pytest.mark.parametrize(
    "whole, part",
    [
        ("word " * 4000, "word " * 2000),
        ("one line of a few words\n" * 64, "one line of a few words\n" * 32),
        ("x" * 20_000, "x" * 10_000),
        ("日本語" * 3000, "日本語" * 1500),
        ("".join(words(7, 4000)), "".join(words(7, 4000))[:5700]),
    ],
)
def test_likeness_of_repeats_and_of_lines_without_blanks(whole, part):
    """Half of a text shares two thirds of both texts' paragraphs, however often one of them is repeated."""
    assert len(mh.paragraphs(whole)) >= 60
    assert mh.likeness(mh.fingerprint(whole), mh.fingerprint(part)) == pytest.approx(2 / 3, abs=0.17)


def test_long_words_are_cut_by_content():
    word = "".join(words(8, 2000))
    parts = mh.paragraphs(word)
    assert b"".join(parts).decode() == word and max(map(len, parts)) <= mh.STRETCH * mh.CUT_BYTES
    assert len(set(parts) & set(mh.paragraphs("new" + word))) >= len(set(parts)) - 5


def test_parts_that_share_paragraphs_are_summed():
    part = text_of(2, 9) + "\n" + text_of(2, 9)
    assert mh.add(mh.fingerprint(part), mh.fingerprint(text_of(2, 9))) == mh.fingerprint(part + "\n" + text_of(2, 9))


def test_likeness_of_many_paragraphs():
    """The lanes have no largest value that sums of many would show."""
    lines = [str(k) for k in range(200_000)]
    got = mh.likeness(mh.fingerprint("\n".join(lines)), mh.fingerprint("\n".join(lines[:100_000] + [f"e{k}" for k in lines[100_000:]])))
    assert got == pytest.approx(0.5, abs=0.2)


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        one, two, three = (mh.fingerprint(t) for t in (text, changed, following))
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), one.hex(), two.hex(), mh.likeness(one, two), mh.likeness(one, three)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_range", [256, 3])
def test_equals_brute_force(spark, monkeypatch, per_range):
    monkeypatch.setattr(mh, "PER_RANGE", per_range)
    rows = [(k * 7 % 101, text_of(k, 1 + k % 7)) for k in range(60)] + [(500, ""), (501, "é"), (502, None), (-3, "日本\nx"), (2**62, "big")]
    assert sorted(map(tuple, mh.fingerprint_edits(documents(spark, rows)).collect()), key=repr) == brute(rows)


def test_odd_rows(spark):
    table = frame(spark)
    got = mh.fingerprint_edits(table).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in table.collect())
    prints = {r.doc_id: r.fingerprint for r in got if r.doc_id is not None}
    assert prints[1] == prints[2] != prints[3]
    one = mh.fingerprint_edits(documents(spark, [(1, "abcd")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_empty_table(spark):
    assert mh.fingerprint_edits(frame(spark, [])).collect() == []
