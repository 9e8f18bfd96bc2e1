"""Mixing sources to target weights by drawing fixed-length blocks.

**Packing.** The words of a source's documents, in a fixed order, form one stream that is cut into blocks of ``BLOCK``
words (the last may be shorter); a document lies in consecutive blocks.

**Targets.** Sources share ``SHARE`` of all words by weight; a target stops at ``MOST`` times the source's size, and
the excess is shared by weight among the others until none is above.

**Drawing.** The mixture is a sequence of output shards of ``SLOTS`` slots, one block each.  A shard's counts per source
are multinomial, given that all shards together take each source's target: drawn from the top by halving, a range of
shards splits its counts into two halves by a multivariate hypergeometric draw whose seed is the range.  So every shard
knows its counts, and those of all shards before it, from a logarithmic number of draws, without the other shards.

**Permutation.** The n-th slot of a source takes block ``P(n mod blocks)``, where ``P`` is a pseudorandom permutation of
the source's block numbers keyed by source and pass (four Feistel rounds, walked until the number is in range).  A pass
takes each block once, so no document is taken more than ``MOST`` times.  Slots and pieces then meet by block number.

A source of any size is numbered in parallel: its documents lie in hash buckets of about ``BUCKET`` rows that are
summed first.  The per-source table is on the driver: one row per distinct source.

Rules: words are runs other than the six ASCII white-space characters; a null text has none; null is a source, the last;
rows without words are returned with zero taken; rows with null or repeated ids are rows of their own; other columns are
ignored.  The result depends only on the rows and the seed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import mixed, small_table, stored, utf8

BLOCK = 64  # words of a block
SLOTS = 1024  # blocks of a full output shard
BUCKET = 1024  # rows of a source that are numbered together, on average
WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
SHARE = 1.5  # words of the mixture, as a multiple of all words
MOST = 2.0  # of a source's size, at most
ROWS = 250  # texts that a task cuts together


@dataclass(frozen=True)
class Source:
    """A source's place, words, target, whole blocks and drawn slots."""

    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words to take of each source."""
    out, free, rest = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while free:
        total = sum(weights[k] for k in free)
        full = [k for k in free if rest * weights[k] / total > most * sizes[k]]
        if not full:
            for k in free:
                out[k] = rest * weights[k] / total
            break
        for k in full:
            out[k] = most * sizes[k]
        rest -= sum(out[k] for k in full)
        free -= set(full)
    return out


def plan(sizes: list[tuple[str | None, int]], weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[Source]:
    """Sources by code point, null last, with targets and slots."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    goal = targets([n for _, n in ordered], [weights[k % len(weights)] for k in range(len(ordered))], share, most)
    out = []
    for (name, size), target in zip(ordered, goal, strict=True):
        blocks = -(-size // BLOCK)
        # Each pass has all words once, hence slots for the whole passes and for what is left of the target.
        passes = int(target // size) if size else 0
        slots = passes * blocks + min(blocks, round((target - passes * size) / BLOCK))
        out.append(Source(name, size, target, blocks, slots))
    return out


def _halve(counts: np.ndarray, left: int, total: int, seed: tuple[int, ...]) -> np.ndarray:
    """How many of ``counts`` (summing to ``total``) fall among the first ``left`` slots."""
    if total < 900_000_000:
        return np.random.default_rng(seed).multivariate_hypergeometric(counts, left, method="marginals")
    # So many slots that the draw's spread is far below one in ten thousand: split in proportion, by largest remainders.
    exact = [int(c) * left for c in counts]
    out = np.array([e // total for e in exact])
    for k in sorted(range(len(exact)), key=lambda k: -(exact[k] % total))[: left - int(out.sum())]:
        out[k] += 1
    return out


def shard_counts(slots: np.ndarray, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots per source of all earlier shards, and of this one."""
    total = int(slots.sum())
    low, high = 0, -(-total // SLOTS)
    before, own = np.zeros_like(slots), slots
    while high - low > 1:
        middle = (low + high) // 2
        whole = min(high * SLOTS, total) - low * SLOTS
        first = _halve(own, (middle - low) * SLOTS, whole, (seed, low, high))
        if shard < middle:
            high, own = middle, first
        else:
            low, before, own = middle, before + first, own - first
    return before, own


def permuted(n: np.ndarray, size: int, key: int) -> np.ndarray:
    """Images of ``n`` under a keyed pseudorandom permutation of 0 .. size - 1."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = n.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for turn in range(4):
            left, right = right, left ^ (mixed(right + np.uint64((key * 4 + turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo[todo] = x[todo] >= size
    return x.astype(np.int64)


def _draw(sources: list[Source], seed: int):
    schema = pa.schema([("shard", pa.int64()), ("slot", pa.int64()), ("source_no", pa.int32()), ("pass_no", pa.int32()), ("block", pa.int64())])
    slots = np.array([s.slots for s in sources], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                before, own = shard_counts(slots, shard, seed)
                number, turn, block = [], [], []
                for k in np.flatnonzero(own):
                    n = before[k] + np.arange(own[k])
                    for p in np.unique(n // sources[k].blocks):
                        at = n[n // sources[k].blocks == p] % sources[k].blocks
                        block.append(permuted(at, sources[k].blocks, (int(p) << 32) + int(k)))
                        number += [k] * len(at)
                        turn += [p] * len(at)
                place = np.random.default_rng((seed, 1, shard)).permutation(len(number))
                columns = [np.full(len(number), shard), place, number, turn, np.concatenate(block)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pa.array([len(t.as_py().split()) for t in batch.column(0)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], sizes], names=[*batch.schema.names[1:], "size"])


@dataclass(frozen=True)
class Mixture:
    """``slots``: shard, slot, source_no, pass_no, block.  ``pieces``: the rows' words by block, from ``start`` on in a row
    that lies at ``place`` in its source.  ``rows``: every row with its place.  ``sources``: the plan."""

    rows: DataFrame
    slots: DataFrame
    pieces: DataFrame
    sources: list[Source]


def mix(docs: DataFrame, seed: int = 1, keep: tuple[str, ...] = ("doc_id",)) -> Mixture:
    """The mixture of ``docs`` (``text``, ``source`` and the columns to keep)."""
    spark = docs.sparkSession
    sized = docs.select(utf8().alias("text"), F.col("source").cast("string").alias("source"), *keep)
    kinds = {f.name: f.dataType.simpleString() for f in sized.schema}
    sized = stored(sized.mapInArrow(_words, ", ".join(f"`{c}` {kinds[c]}" for c in ("source", *keep)) + ", size bigint"))

    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    sources = plan([(r["source"], r["size"]) for r in totals])
    buckets = {r["source"]: max(1, r["n"] // BUCKET) for r in totals}
    table = small_table(spark, "source string, source_no int, buckets long", [(s.name, k, buckets[s.name]) for k, s in enumerate(sources)])
    rows = sized.withColumnRenamed("source", "name").join(F.broadcast(table), F.col("name").eqNullSafe(F.col("source"))).drop("name")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*keep, "size"), "buckets"))

    of_bucket = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    by_bucket = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    of_bucket = stored(of_bucket.select("source_no", "bucket", F.coalesce(F.sum("words").over(by_bucket), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("source_no", "bucket").orderBy(*keep, "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = stored(rows.join(of_bucket, ["source_no", "bucket"]).select(*keep, "source", "source_no", "size", (F.col("place") + F.col("offset")).alias("place")))

    blocks = F.sequence(F.floor(F.col("place") / BLOCK), F.floor((F.col("place") + F.col("size") - 1) / BLOCK))
    pieces = rows.where("size > 0").select(*keep, "source_no", "size", "place", F.explode(blocks).alias("block"))
    start: Column = F.greatest(F.col("block") * BLOCK - F.col("place"), F.lit(0))
    end: Column = F.least((F.col("block") + 1) * BLOCK - F.col("place"), F.col("size"))
    pieces = pieces.withColumn("start", start).withColumn("length", end - start)

    shards = math.ceil(sum(s.slots for s in sources) / SLOTS)
    tasks = max(1, min(shards, math.ceil(shards / 64)))
    slots = spark.range(0, shards, 1, tasks).mapInArrow(_draw(sources, seed), "shard bigint, slot bigint, source_no int, pass_no int, block bigint")
    return Mixture(rows, slots, pieces, sources)


def taken_words(mixture: Mixture, key: str = "doc_id") -> DataFrame:
    """Per row: key, size, source_size, target, and the words that the mixture takes of it."""
    spark = mixture.rows.sparkSession
    times = mixture.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    # A small plan may draw many slots: sizes are not known beforehand, so neither side is broadcast.
    of_row = mixture.pieces.join(times.hint("merge"), ["source_no", "block"]).groupBy(key, "source_no", "place", "size").agg(F.sum(F.col("length") * F.col("times")).alias("taken"))
    same = F.col("r.source_no").eqNullSafe(F.col("t.source_no")) & (F.col("r.place") == F.col("t.place")) & (F.col("r.size") == F.col("t.size"))
    found = mixture.rows.alias("r").join(of_row.alias("t"), same, "left").select("r.*", F.coalesce("t.taken", F.lit(0)).alias("taken"))
    table = small_table(spark, "source_no int, source_size long, target double", [(k, s.size, s.target) for k, s in enumerate(mixture.sources)])
    return found.join(F.broadcast(table), "source_no").select(key, "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken"))


def _cut(columns: list[str], at: int):
    """Replaces column ``at`` (a text) by the words that ``parts`` (the last column: pass, start, length) name."""
    words = re.compile(rb"[^\x20\x09-\x0D]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(low, ROWS) for whole in batches for low in range(0, len(whole), ROWS)):
            out = []
            for text, parts in zip(batch.column(at), batch.column(len(columns))):
                parts = sorted((p["pass_no"], p["start"], p["length"]) for p in parts.as_py())
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                begins = [m.start() for m in words.finditer(data)]
                begins = [0, *begins[1:], len(data)]  # a word goes with the white space behind it
                pieces: list[bytes] = []
                before = None
                for turn, start, length in parts:
                    if before is not None and (turn, start) != before and not pieces[-1][-1:].isspace():
                        pieces.append(b"\n")
                    pieces.append(data[begins[start] : begins[start + length]])
                    before = turn, start + length
                out.append(b"".join(pieces).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(out, pa.string()), *batch.columns[at + 1 : len(columns)]], names=columns)

    return run


def mixed_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``source``, ``n_chars`` and more) with the texts that the mixture takes of them.

    A document's blocks follow one another as in its text, those of a second pass after those of the first; a document
    taken once as a whole keeps its text as it is, and one that no slot takes is left out.  ``n_chars`` is set anew.
    Rows with equal ids and texts get the parts of one of them.
    """
    keyed = docs.withColumn("_text_key", F.xxhash64("text"))
    mixture = mix(keyed, seed, ("doc_id", "_text_key"))
    key = ["doc_id", "_text_key"]
    taken = mixture.pieces.join(mixture.slots.hint("merge"), ["source_no", "block"])
    parts = taken.groupBy(*key, "place").agg(F.collect_list(F.struct("pass_no", "start", "length")).alias("parts"))
    parts = parts.groupBy(*key).agg(F.min_by("parts", "place").alias("parts"))
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d._text_key") == F.col("p._text_key"))
    rows = keyed.alias("d").join(parts.alias("p"), same).select(*(F.col(f"d.`{c}`") for c in docs.columns), "p.parts")
    out = rows.mapInArrow(_cut(docs.columns, docs.columns.index("text")), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
