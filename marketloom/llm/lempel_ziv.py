"""Substring dedup: words covered by long passages that occur elsewhere too, found by relative Lempel-Ziv parsing.

A window is ``window`` consecutive words of one text.  It repeats if its words also start anywhere else, in the same
text or in another; words covered by a repeating window go.  Windows are judged on the input, not on what is left.

**Routing.** Parsing every text against every reference block would be quadratic.  Each window is therefore named by the
run of ``gram`` words in it whose hash is smallest, its anchor; equal windows have equal anchors.  Consecutive windows
with one anchor form a stretch of at most ``2 * window - gram`` words.  Anchors that occur once are done with.  A stretch
that occurs several times as a whole repeats as a whole.  What is left are anchors with different stretches.

**Parsing.** All stretches of an anchor go to one reference block, each stretch once.  A block is indexed by naming its
substrings of 1, 2, 4, ... words and sorting its suffixes, so the longest match of a suffix elsewhere in the block is one
with a neighbour in that order.  Every stretch is factored greedily against the block: a factor is the longest match from
where the last one ended, or one word.  Windows inside a factor of ``window`` words and more repeat.  Any other repeating
window must cross the boundary of two neighbouring factors and reach no further (behind a factor stands a word with
which it does not match any more), so for those the longest matches are looked up at the boundary.

**Hot anchors.** Of a passage that most texts hold, the anchors at its ends have as many stretches as there are texts.  An
anchor with more than ``HOT`` different stretches isn't given to one block: its windows are counted by their hashes, combined before
the shuffle, which decides the same.

Words are runs other than the six ASCII white-space characters, unchanged; they are compared by 64-bit hashes.  Null and
empty texts have no words.  Rows are known by id and text: equal rows get equal results, and each of them counts as an
occurrence; a null id is an id like others.  Other columns are ignored.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import mixed, stored, utf8

WINDOW = 35
GRAM = 8  # words of an anchor, for windows of more than 16 words
BLOCK = 8192  # stretches of a reference block, about
HOT = 2048  # different stretches of an anchor up to which they are parsed in a block
BASE = 0x9E3779B97F4A7C15
NO_ID = -(1 << 63)  # stands for a null id in joins


def gram_words(window: int) -> int:
    """Words of an anchor: few enough to be rare, and so many that a stretch has at most 62 windows."""
    return max(1, min(GRAM, window // 2), window - 61)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Rolling:
    """Hashes of any run of a sequence, from sums of its hashes times powers of an odd base modulo 2**64."""

    def __init__(self, h: np.ndarray):
        with np.errstate(over="ignore"):
            n = len(h) + 1
            powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, BASE, np.uint64)))[:n])
            self.back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, pow(BASE, -1, 1 << 64), np.uint64)))[:n])
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(h) * powers[:-1])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def lowest(values: np.ndarray, count: int) -> np.ndarray:
    """Position of the first smallest of ``count`` consecutive values, for each start."""
    at, size = np.arange(len(values)), 1
    while size < count:
        step = min(size, count - size)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        size += step
    return at


def stretches(h: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Of texts one behind the other: text, anchor, hash, first window and number of windows of each stretch."""
    gram = gram_words(window)
    ends = np.cumsum(lengths)
    text = np.repeat(np.arange(len(lengths)), lengths)
    n = len(h) - window + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    rolling = Rolling(h)
    grams = np.arange(len(h) - gram + 1)
    grams = rolling.of(grams, grams + gram)
    anchor = lowest(grams, window - gram + 1)
    starts = np.flatnonzero(np.arange(window, window + n) <= ends[text[:n]])
    if not len(starts):
        return stretches(h[:0], lengths[:0], window)
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(starts) > 1) | (np.diff(anchor[starts]) != 0))))
    first, count = starts[cut], np.diff(np.append(cut, len(starts)))
    whole = rolling.of(first, first + count - 1 + window)
    owner = text[first]
    return owner, grams[anchor[first]].view(np.int64), whole.view(np.int64), first - (ends - lengths)[owner], count


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.slice(low, 500)
                texts = [t.as_py().split() for t in part.column(2)]
                lengths = np.array([len(t) for t in texts])
                owner, anchor, whole, first, count = stretches(word_hashes([w for t in texts for w in t]), lengths, window)
                ids = [part.column(k).to_numpy()[owner] for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*ids, anchor, whole, first.astype(np.int32), count.astype(np.int32))], names=["did", "tid", "anchor", "stretch", "first", "windows"])

    return run


def _words_of(window: int):
    """Rows: did, tid, text, and the stretches wanted of it; gives the hashes of each stretch's words."""
    names = ["anchor", "stretch", "copies", "kinds", "did", "tid", "first", "windows", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for row in range(len(batch)):
                did, tid, text, wanted = (batch.column(k)[row] for k in range(4))
                # Equal rows mostly stand together; the rest of them are told apart in the blocks.
                own, before = (did.as_py(), tid.as_py()), before
                if own == before:
                    continue
                before = own
                wanted = wanted.values
                words = text.as_py().split()
                first, windows = wanted.field("first").to_numpy(), wanted.field("windows").to_numpy()
                found = [word_hashes(words[f : f + n - 1 + window]).tobytes() for f, n in zip(first.tolist(), windows.tolist(), strict=True)]
                same = [pa.array(np.full(len(found), x)) for x in own]
                yield pa.RecordBatch.from_arrays(
                    [*(wanted.field(k) for k in names[:4]), *same, wanted.field("first"), wanted.field("windows"), pa.array(found, pa.binary())], names=names
                )

    return run


class Block:
    """A reference block: its words in one sequence, a mark of its own behind each stretch, with the longest match elsewhere."""

    def __init__(self, parts: list[np.ndarray]):
        lengths = np.array([len(p) for p in parts])
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        self.ends = self.starts + lengths
        n = int(lengths.sum()) + len(parts)
        words = np.ones(n, bool)
        words[self.ends] = False
        known, code = np.unique(np.concatenate(parts), return_inverse=True)
        names = np.empty(n, np.int64)
        names[words] = code
        names[self.ends] = len(known) + np.arange(len(parts))
        levels = [names]  # level k: equal names for equal runs of 2**k, in their order
        while names.max() + 1 < n:
            behind = np.zeros(n, np.int64)
            step = 1 << (len(levels) - 1)
            behind[: n - step] = names[step:] + 1
            names = np.unique(names * (n + 1) + behind, return_inverse=True)[1]
            levels.append(names)
        order = np.argsort(names, kind="stable")
        a, b = order[:-1], order[1:]
        common = np.zeros(n - 1, np.int64)
        for k in range(len(levels) - 2, -1, -1):
            common += (levels[k][a + common] == levels[k][b + common]).astype(np.int64) << k
        self.match = np.zeros(n, np.int64)
        self.match[a] = common
        self.match[b] = np.maximum(self.match[b], common)

    def factors(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The greedy factors of all stretches, in turns: which stretch, where, how long."""
        which, at = np.arange(len(self.starts)), self.starts
        while len(which):
            size = np.maximum(self.match[at], 1)
            yield which, at, size
            at = at + size
            more = at < self.ends[which]
            which, at = which[more], at[more]

    def repeats(self, window: int) -> np.ndarray:
        """Whether a repeating window starts at each word of the sequence."""
        found = np.zeros(len(self.match), bool)
        before = np.zeros((2, len(self.starts)), np.int64)  # place and length of the factor before
        for which, at, size in self.factors():
            found[_ranges(at, at + size - window + 1)] = True
            place, length = before[:, which]
            crossing = _ranges(place + 1, np.where(length > 0, np.minimum(at, at + size - window + 1), 0))
            found[crossing] |= self.match[crossing] >= window
            before[:, which] = at, size
        return found


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All whole numbers from ``low`` up to before ``high``, of each pair."""
    n = np.maximum(high - low, 0)
    return np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _parsed(window: int):
    """Rows sorted by their first column, block; gives which windows of each stretch repeat, as bits."""

    def block_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        windows = rows.column("windows").to_numpy()
        block = Block([np.frombuffer(w.as_py(), np.uint64) for w in rows.column("words")])
        step = np.arange(62)
        inside = step < windows[:, None]
        found = block.repeats(window)[np.minimum(block.starts[:, None] + step, len(block.match) - 1)] & inside
        bits = (found.astype(np.int64) << step).sum(axis=1)
        return pa.RecordBatch.from_arrays([*(rows.column(k).combine_chunks() for k in ("did", "tid", "first")), pa.array(bits)], names=["did", "tid", "first", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            block = batch.column(0).to_numpy()
            cut = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
            for low, high in zip(cut[:-1], cut[1:], strict=True):
                part = batch.slice(low, high - low)
                if held and held[0].column(0)[0] != part.column(0)[0]:
                    yield block_of(held)
                    held = []
                if len(part):
                    held.append(part)
        if held:
            yield block_of(held)

    return run


def _windows_of(window: int):
    """Rows: anchor, did, tid, first, words, copies; gives the hash of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(w.as_py(), np.uint64) for w in batch.column(4)]
            lengths = np.array([len(p) for p in parts], np.int64)
            count = lengths - window + 1
            if not len(parts):
                continue
            start = _ranges(np.cumsum(lengths) - lengths, np.cumsum(lengths) - window + 1)
            hashes = Rolling(np.concatenate(parts)).of(start, start + window).view(np.int64)
            anchor, did, tid, first, copies = (np.repeat(batch.column(k).to_numpy(), count) for k in (0, 1, 2, 3, 5))
            at = first + _ranges(np.zeros(len(parts), np.int64), count)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, hashes, did, tid, at.astype(np.int32), copies)], names=["anchor", "hash", "did", "tid", "first", "copies"])

    return run


def _kept(window: int):
    """Rows: doc_id, text, first windows and their bits; gives doc_id, n_words, n_removed and the kept words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.arange(62)
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.slice(low, 500)
                words, gone, kept = [], [], []
                for text, spans in zip(part.column(1), part.column(2), strict=True):
                    own = text.as_py().split()
                    words.append(len(own))
                    if spans.is_valid:
                        first, bits = (spans.values.field(k).to_numpy() for k in (0, 1))
                        start = (first[:, None] + step)[(bits[:, None] >> step) & 1 == 1]
                        change = np.zeros(len(own) + 1, np.int64)
                        np.add.at(change, start, 1)
                        np.add.at(change, start + window, -1)
                        free = np.cumsum(change[:-1]) == 0
                        own = list(compress(own, free.tolist()))
                    gone.append(words[-1] - len(own))
                    kept.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def repeating_windows(texts: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """Of ``texts`` (did, tid, text as bytes), per text with repeating windows: did, tid, and spans of a first window and bits."""
    cuts = "did bigint, tid bigint, anchor bigint, stretch bigint, first int, windows int"
    cuts = stored(texts.mapInArrow(_cut(window), cuts))
    # Stored sides: a join with an aggregate on the same key could not be split where a key is hot.
    shared = stored(cuts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    cuts = stored(cuts.join(shared, "anchor", "left_semi"))
    groups = cuts.groupBy("anchor", "stretch").agg(F.count("*").alias("copies"), F.min(F.struct("did", "tid", "first", "windows")).alias("one"))
    groups = stored(groups.select("anchor", "stretch", "copies", "one.*"))

    # Undecided: stretches of an anchor that has several, one of them a single one.
    kinds = groups.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("least")).where("kinds > 1 and least = 1").select("anchor", "kinds")
    wanted = groups.join(stored(kinds), "anchor").groupBy("did", "tid").agg(F.collect_list(F.struct("anchor", "stretch", "copies", "kinds", "first", "windows")).alias("wanted"))
    ddl = "anchor bigint, stretch bigint, copies bigint, kinds bigint, did bigint, tid bigint, first int, windows int, words binary"
    open_ones = texts.join(wanted, ["did", "tid"]).select("did", "tid", "text", "wanted")
    open_ones = stored(open_ones.mapInArrow(_words_of(window), ddl))

    n_blocks = -(-open_ones.count() // BLOCK) or 1
    block = F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)).alias("block")
    blocks = open_ones.where(F.col("kinds") <= hot).select(block, "did", "tid", "first", "windows", "words")
    parsed = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_parsed(window), "did bigint, tid bigint, first int, bits bigint")

    ddl = "anchor bigint, hash bigint, did bigint, tid bigint, first int, copies bigint"
    single = open_ones.where(F.col("kinds") > hot).select("anchor", "did", "tid", "first", "words", "copies").mapInArrow(_windows_of(window), ddl)
    twice = stored(single.groupBy("anchor", "hash").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "hash"))
    counted = single.where("copies = 1").join(twice, ["anchor", "hash"], "left_semi").select("did", "tid", "first", F.lit(1).cast("bigint").alias("bits"))

    several = groups.where("copies > 1").select("anchor", "stretch")
    all_of_it = (F.expr("shiftleft(1L, windows)") - 1).alias("bits")
    whole = cuts.join(several, ["anchor", "stretch"], "left_semi").select("did", "tid", "first", all_of_it)
    spans = whole.unionByName(parsed).unionByName(counted).where("bits <> 0")
    spans = spans.groupBy("did", "tid", "first").agg(F.bit_or("bits").alias("bits"))
    return spans.groupBy("did", "tid").agg(F.collect_list(F.struct("first", "bits")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept (the words that stay, joined by one space)."""
    doc_id = F.col("doc_id").cast("bigint")
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("did"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid"), utf8().alias("text"))
    spans = repeating_windows(texts.select("did", "tid", "text"), window, hot)
    rows = texts.join(spans, ["did", "tid"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_kept(window), "doc_id bigint, n_words bigint, n_removed bigint, kept string")
