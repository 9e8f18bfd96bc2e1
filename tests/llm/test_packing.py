from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketloom.llm import packing
from tests.llm.rows import frame, words

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_tokenizers(plain):
    r = random.Random(2)
    stock = [" ", "\n", "  ", "\t", "a", "it's", "Été", "12", "!!", "...", "日本", " ", "word", "<|endoftext|>", "\r\n", "'ll", "x"]
    texts = ["", " ", "\n", "a", " a", "a ", "a\n b", "a \nb", "don't\nwe'll"] + ["".join(r.choice(stock) for _ in range(r.randrange(30))) for _ in range(1500)]
    encode = packing.Encoder(PATH)
    for text in texts:
        assert encode(text).tolist() == plain(text), repr(text)


def test_added_tokens_in_a_text_have_their_ids(spark):
    """As ``tokenizers`` with its own settings, in the encoder and in the rows."""
    tokenizer = Tokenizer.from_file(PATH)
    encode, r = packing.Encoder(PATH, added=True), random.Random(4)
    stock = [" ", "\n", "a", "it's", "12", "日本", "<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", "x"]
    texts = ["see <|endoftext|> here", "<|endoftext|>"] + ["".join(r.choice(stock) for _ in range(r.randrange(20))) for _ in range(500)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [encode(t).tolist() for t in texts] == want and want[0] == [3826, 220, 50256, 994]
    docs = spark.createDataFrame(list(enumerate(texts[:20])), "doc_id long, text string")
    rows = packing.pack(docs, PATH, added=True).collect()
    assert {x.doc_id: x.doc_tokens for x in rows} == {k: len(ids) + 1 for k, ids in enumerate(want[:20])}


def test_balance_leaves_less_than_one_sequence_empty():
    r = random.Random(3)
    lengths = [r.randrange(1, 1024) for _ in range(500)] + [0, 5]
    room = defaultdict(int)
    parts = defaultdict(list)
    for rest, start, n, at, offset in packing.balance(lengths, 1024):
        assert room[at] == offset
        room[at] += n
        parts[rest].append((start, n))
    assert len(room) == -(-sum(lengths) // 1024) and max(room.values()) <= 1024
    for rest, n in enumerate(lengths):
        at = 0
        for start, length in sorted(parts[rest]):
            assert start == at
            at += length
        assert at == n


def test_balance_evens_costs():
    """Pieces that fit whole go to the cheapest sequence: long pieces are not put together."""
    out = packing.balance([500, 500, 500, 500, 24, 24, 24, 24, 24, 24], 1024)
    assert sorted(n for _, _, n, at, _ in out if n == 500) == [500] * 4
    assert max(sum(n == 500 for _, _, n, a, _ in out if a == at) for at in {o[3] for o in out}) == 2


def check(rows, texts, plain, size=1024):
    room, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        room[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append(r)
    for pieces in room.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at <= size
    for doc, text in texts.items():
        ids, at = [*plain(text or ""), 0], 0
        for r in sorted(parts[doc], key=lambda r: r.start):
            own = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(own.tobytes()))
            at += r.length
        assert at == len(ids)
    return room


def test_pieces_cover_all_ids(spark, plain):
    texts = {k: " ".join(words(k, n)) for k, n in enumerate([0, 1, 5, 300, 4000, 700, 20, 20, 20, 900, 1500])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    room = check(packing.pack(docs, PATH).collect(), texts, plain)
    assert sum(1024 - sum(n for _, n in p) for p in room.values()) < 1024


def test_odd_rows(spark, plain):
    table = frame(spark)
    rows = packing.pack(table, PATH).collect()
    texts = {r.doc_id: r.text for r in table.collect() if r.doc_id not in (None, 11, 12)}
    for doc, text in texts.items():
        own = sorted((r.start, r.length) for r in rows if r.doc_id == doc)
        assert sum(n for _, n in own) == len(plain(text or "")) + 1
    assert sum(r.length for r in rows if r.doc_id == 11) == 2 * (len(plain("same")) + 1)


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).collect() == []
