"""Cost-balanced packing of token sequences.

A document's token ids are cut into full sequences of ``size`` tokens and one rest.  Rests are packed in windows of
``WINDOW`` documents: a piece of ``l`` tokens is estimated to cost ``l * LINEAR + l * l * QUADRATIC`` (attention stays
inside a document), pieces go by descending length to the sequence of the window with the lowest cost that has room, and
where no sequence has room for a whole piece it is cut to fill the one of lowest cost.  A window has as many sequences as
its tokens need, so its padding is less than one sequence.

A task tokenizes its own part of the input and packs as it reads, so the text is never shuffled and a task that is run
again gives the same pieces.  Sequence ids are the task's number and a counter.  Memory holds one window of rests.

Token ids are those of a ``tokenizers`` file; pieces of text between single spaces or line ends, which the tokenizer's pattern
never joins, are tokenized once per worker and looked up after that.

An added token of the file, such as ``<|endoftext|>``, that stands in a text is cut into ordinary tokens, or, with ``added``,
gets its own id as in ``tokenizers``; the queries do the latter.

Rules: a null text is empty and has only the closing id; texts of any length are read whole; rows with null or repeated
ids are documents of their own; ties go by the order of reading; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 4096  # documents whose rests are packed together
LINEAR, QUADRATIC = 1.0, 1.0 / 1024  # cost of a token, and of a pair of tokens
CACHED = 300_000  # tokenized pieces of text that a worker keeps

#: White space beside white space or at an end: such texts are tokenized in one go.
_UNEVEN = re.compile(r"\s\s|^\s|\s$")

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class _Pieces(dict):
    """Token ids, as bytes, of a piece of text after a given prefix."""

    def __init__(self, encode, prefix: str):
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(self.prefix + piece)
        if len(self) < CACHED:
            self[piece] = ids
        return ids


#: Fixed value: how the vocabulary's pattern divides a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _vocabulary(path: str) -> dict[bytes, int]:
    """Bytes and id of every token but the special ones, from a byte-level tokenizer file of ``tokenizers``."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"] for t in model.get("added_tokens", [])}
    return {bytes(byte[c] for c in token): k for token, k in model["model"]["vocab"].items() if token not in special}


def _added(path: str) -> dict[str, int]:
    """Content and id of the added tokens."""
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file).get("added_tokens", [])}


class Encoder:
    """Token ids of whole texts by a byte-level BPE of ``tokenizers`` whose pattern joins at most one space to a word.

    The merges run in ``tiktoken``, which takes a third of the time for the same ids; tests compare the two.
    """

    def __init__(self, path: str, added: bool = False):
        import tiktoken

        own = _added(path) if added else {}
        self.ids = {content: np.array([k], "<u4") for content, k in own.items()}
        self.literals = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")") if own else None
        bpe = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=_vocabulary(path), special_tokens={})
        self.whole = lambda text: array("I", bpe.encode_ordinary(text)).tobytes()
        self.first, self.later = _Pieces(self.whole, ""), _Pieces(self.whole, " ")
        self.line = self.whole("\n")

    def __call__(self, text: str) -> np.ndarray:
        if self.literals and self.literals.search(text):
            parts = self.literals.split(text)
            return np.concatenate([self.ids[p] if k % 2 else self._ordinary(p) for k, p in enumerate(parts)])
        return self._ordinary(text)

    def _ordinary(self, text: str) -> np.ndarray:
        if _UNEVEN.search(text):
            data = self.whole(text)
        else:
            lines = []
            for line in text.split("\n"):
                head, *rest = line.split(" ")
                lines.append(self.first[head] + b"".join(map(self.later.__getitem__, rest)))
            data = self.line.join(lines)
        return np.frombuffer(data, "<u4")


@functools.cache
def encoder(path: str, added: bool = False) -> Encoder:
    """One per Python worker."""
    return Encoder(path, added)


def cost(length: int) -> float:
    return length * LINEAR + length * length * QUADRATIC


def balance(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces of the rests: rest, first token in it, length, sequence, offset in the sequence."""
    room = np.full(-(-sum(lengths) // size), size)
    used = np.zeros(len(room))
    todo = [(-n, k, 0) for k, n in enumerate(lengths) if n]
    heapq.heapify(todo)
    out = []
    while todo:
        n, rest, start = heapq.heappop(todo)
        n = -n
        at = int(np.where(room >= n, used, np.inf).argmin())
        if room[at] < n:  # no room for the whole piece: fill the sequence of lowest cost
            at = int(np.where(room > 0, used, np.inf).argmin())
            cut = int(room[at])
            heapq.heappush(todo, (cut - n, rest, start + cut))
            n = cut
        out.append((rest, start, n, at, size - int(room[at])))
        room[at] -= n
        used[at] += cost(n)
    return out


def _pack(path: str, size: int, end: int, added: bool):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])
    closing = np.array([end], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, added)
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        rests: list[tuple] = []
        rows: list[tuple] = []

        def packed():
            nonlocal number, rests, rows
            for rest, start, n, at, offset in balance([len(r[3]) for r in rests], size):
                doc, before, total, ids = rests[rest]
                rows.append((doc, before + start, n, zlib.crc32(ids[start : start + n].tobytes()), total, number + at, offset))
            number += -(-sum(len(r[3]) for r in rests) // size)
            result = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(schema))], schema=schema)
            rests, rows = [], []
            return result

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate((encode(text.as_py()), closing))
                full = len(ids) // size * size
                for start in range(0, full, size):
                    rows.append((doc, start, size, zlib.crc32(ids[start : start + size].tobytes()), len(ids), number, 0))
                    number += 1
                if full < len(ids):
                    rests.append((doc, full, len(ids), ids[full:].copy()))
                if len(rests) == WINDOW or len(rows) >= 4 * WINDOW:
                    yield packed()
        yield packed()

    return run


def pack(docs: DataFrame, path: str, size: int = 1024, end: int = 0, added: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (``doc_id``, ``text``), see ``SCHEMA``; ``path`` names the tokenizer file."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_pack(path, size, end, added), SCHEMA)
