"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs: its lines, and a long line in parts that end at words chosen by their content.  A
word of more than ``LONG`` bytes is cut the same way at bytes, and a stretch where the content gives no cut, such as one
word or character repeated, at even distances from its beginning.  Each paragraph is hashed to a wide vector, and the
fingerprint is the sum of the vectors:

* ``EQUAL`` lanes of 64 random bits, modulo 2 ** 64: equal sums mean equal multisets, whatever the order;
* ``LANES`` lanes of Cauchy variates in units of 1 / ``UNIT``, modulo 2 ** 32: a sum of such variates is spread as one of
  them times the summed absolute weights, so the median of the difference of two sums estimates how many paragraphs the
  texts do not share, repeats counted;
* one lane that counts paragraphs, modulo 2 ** 32.

Inserting or deleting a paragraph adds or subtracts its vector, so a fingerprint is kept up without the rest of the text
(``add``), and parts of a text can be summed anywhere.

``fingerprint_edits`` compares each text with an edited one and with the next text in descending order of id.  Rows are
dealt once, by ranges of ids whose borders come from quantiles; a range also gets the row that follows it, so a task
reads its ranges in order and holds two texts.

Rules: a null text is empty; the empty text has no paragraphs and an all-zero fingerprint; blank lines are
paragraphs; rows with a null id come last, ties go by the text's hash; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import mixed

EQUAL, LANES = 4, 128  # lanes
UNIT = 64  # of a Cauchy lane: 1 is so many
CUT = 8  # words of a part of a long line, on average
LONG = 128  # bytes of a word that is not cut, at most
CUT_BYTES = 32  # of a part of a longer one, on average
STRETCH = 4  # times those averages without a cut by content, and the stretch is cut evenly
AT_ONCE = 2048  # paragraphs whose vectors are held
PER_RANGE = 256  # rows of a range, about
RANGES = 20_000  # most ranges; their rows are read in a stream, so a range may be of any size

WIDTH = EQUAL * 8 + LANES * 4 + 4  # bytes


def _of_word(word: bytes) -> list[bytes]:
    """Parts of a long word."""
    x = np.frombuffer(word, np.uint8).astype(np.uint64)
    last = x[3:] + (x[2:-1] << np.uint64(8)) + (x[1:-2] << np.uint64(16)) + (x[:-3] << np.uint64(24))
    ends = np.flatnonzero(mixed(last) % np.uint64(CUT_BYTES) == 0) + 4
    out, low = [], 0
    for end in [*ends.tolist(), len(word)]:
        step = end - low if end - low <= STRETCH * CUT_BYTES else CUT_BYTES
        out += [word[k : min(k + step, end)] for k in range(low, end, max(1, step))]
        low = end
    return out


def paragraphs(text: str) -> list[bytes]:
    """Lines, long ones in parts; every character but white space between words is in one of them."""
    out = []

    def close(run: list[bytes]):
        step = len(run) if len(run) <= STRETCH * CUT else CUT
        out.extend(b" ".join(run[k : k + step]) for k in range(0, len(run), max(1, step)))

    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split(b" ")
        if len(words) <= CUT and len(line) <= LONG:
            out.append(line)
            continue
        low = 0
        for k, word in enumerate(words, 1):
            if len(word) > LONG:
                close(words[low : k - 1])
                out += _of_word(word)
                low = k
            elif len(words) > CUT and len(word) and (word[0] * 7 + word[-1] * 31 + len(word)) % CUT == 0:
                close(words[low:k])
                low = k
        close(words[low:])
    return out if text else []


#: Cauchy variates, in units, by 16 random bits; the outermost ones are drawn anew, as there is no largest one.
_CAUCHY = np.rint(UNIT * np.tan(np.pi * ((np.arange(1 << 16) + 0.5) / (1 << 16) - 0.5))).astype(np.int32)
_OUTERMOST = (1 << 16) - 1


def vectors(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row per paragraph: the 64-bit equality lanes, and the Cauchy lanes."""
    base = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    other = np.fromiter((xxhash.xxh3_64_intdigest(p, seed=1) for p in parts), np.uint64, len(parts))
    lanes = np.arange(1, EQUAL + LANES // 4 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    wide = mixed(base[:, None] + lanes)
    wide[:, :EQUAL] = mixed(wide[:, :EQUAL] ^ other[:, None])
    bits = np.ascontiguousarray(wide[:, EQUAL:] ^ other[:, None]).view(np.uint16).reshape(len(parts), LANES)
    values = _CAUCHY[bits]
    row, lane = np.nonzero((bits == 0) | (bits == _OUTERMOST))
    if len(row):
        more = mixed(base[row] ^ mixed(other[row] + lane.astype(np.uint64)))
        size = np.minimum(UNIT * (1 << 16) / np.pi / (((more >> np.uint64(11)) + np.uint64(1)) / 2.0**53), 2.0**31 - 1)
        values[row, lane] = np.where(bits[row, lane] == 0, -size, size).astype(np.int32)
    return wide[:, :EQUAL], values


def fingerprint(text: str) -> bytes:
    parts = paragraphs(text)
    often = Counter(parts)
    distinct, times = list(often), np.fromiter(often.values(), np.int64, len(often))
    equal, lanes = np.zeros(EQUAL, np.uint64), np.zeros(LANES, np.int64)
    for low in range(0, len(distinct), AT_ONCE):
        some, n = distinct[low : low + AT_ONCE], times[low : low + AT_ONCE]
        wide, values = vectors(some)
        equal += (wide * n.astype(np.uint64)[:, None]).sum(axis=0, dtype=np.uint64)
        lanes += values.sum(axis=0, dtype=np.int64)
        again = np.flatnonzero(n > 1)
        if len(again):
            lanes += ((n[again] - 1)[:, None] * values[again]).sum(axis=0)
    return equal.tobytes() + lanes.astype("<u4", casting="unsafe").tobytes() + np.array([len(parts)], "<u4").tobytes()


def add(one: bytes, other: bytes, sign: int = 1) -> bytes:
    """The fingerprint of two multisets together, or (``sign`` -1) of the first without the second."""
    out = []
    for kind, low, high in (("<u8", 0, EQUAL * 8), ("<u4", EQUAL * 8, WIDTH - 4), ("<u4", WIDTH - 4, WIDTH)):
        a, b = np.frombuffer(one[low:high], kind), np.frombuffer(other[low:high], kind)
        out.append((a + b if sign > 0 else a - b).tobytes())
    return b"".join(out)


def likeness(one: bytes, other: bytes) -> float:
    """Estimated share of paragraphs in common, of both texts' paragraphs: 1 for equal multisets."""
    if one == other:
        return 1.0
    a, b = (np.frombuffer(x[EQUAL * 8 : WIDTH - 4], "<u4") for x in (one, other))
    apart = np.median(np.abs((a - b).astype("<i4").astype(float))) / UNIT
    count = sum(int.from_bytes(x[-4:], "little") for x in (one, other))
    return float(min(1.0, max(0.0, 1 - apart / max(1, count))))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in descending order; a row that only follows the range has ``guard`` set."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    rows: list[tuple] = []
    last = None  # range, guard, id, text and fingerprint of the row before

    def flushed():
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        for place, guard, doc, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), batch.column(3), strict=True):
            if guard and last and last[1]:
                continue  # a second copy of the row that follows
            text = text.as_py()
            own = (place, guard, doc, text, fingerprint(text))
            if last and last[0] == place and not last[1]:
                changed = edited(last[3], text)
                print_ = fingerprint(changed)
                rows.append((last[2], len(last[3]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), last[4].hex(), print_.hex(), likeness(last[4], print_), likeness(last[4], own[4])))
            last = own
            if len(rows) == 1000:
                yield flushed()
    yield flushed()


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """See ``COLUMNS``: per row of ``docs`` (``doc_id``, ``text``) its fingerprint, that of the edited text, and likenesses."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    total = rows.agg(F.count("*")).first()[0]
    many = max(1, min(total // PER_RANGE, RANGES))
    borders = rows.stat.approxQuantile("doc_id", [k / many for k in range(1, many)], 0.2 / many) if many > 1 else []
    borders = np.array(sorted(set(borders), reverse=True), dtype=float)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:  # 0 has the largest ids; null ids are in the last range
        return pd.Series(np.searchsorted(-borders, -ids.to_numpy(float), "left").astype(np.int32))

    rows = rows.withColumn("place", F.coalesce(place(F.col("doc_id")), F.lit(len(borders))))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.bitwise_not("doc_id").alias("down"), "tie")
    firsts = rows.groupBy("place").agg(F.min(order).alias("o"), F.min(F.struct(order, "doc_id")).alias("f"))
    firsts = firsts.select("place", F.col("f.doc_id").alias("id"), F.col("o.tie").alias("tie_of_id")).orderBy("place").collect()
    following = [(a["place"], b["id"], b["tie_of_id"]) for a, b in zip(firsts, firsts[1:] + firsts[:1], strict=True)]
    guards = docs.sparkSession.createDataFrame(following, "at int, id bigint, tie_of_id bigint")  # one row per range

    extra = guards.groupBy("id", "tie_of_id").agg(F.collect_list("at").alias("at"))
    rows = rows.join(F.broadcast(extra), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("tie_of_id")), "left")
    own = F.array(F.struct("place", F.lit(False).alias("guard")))
    copies = F.concat(own, F.transform(F.coalesce("at", F.array().cast("array<int>")), lambda a: F.struct(a.alias("place"), F.lit(True).alias("guard"))))
    rows = rows.select(F.explode(copies).alias("p"), "doc_id", "text", "tie").select("p.place", "p.guard", "doc_id", "text", "tie")
    dealt = rows.repartition("place").sortWithinPartitions("place", "guard", F.col("doc_id").desc_nulls_last(), "tie")
    return dealt.mapInArrow(_compare, COLUMNS)
