"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's ``PROFILE`` most frequent n-grams of one to ``ORDER`` characters in order.  A text's own
``PROFILE`` most frequent n-grams are ranked the same way; each is out of place by the difference of its two ranks, or by
``PROFILE`` where the language's profile lacks it, and the language with the smallest sum is the prediction.

N-grams run over lower-cased letters, with one blank for any run of other characters and at both ends; an n-gram of
blanks alone doesn't count.  An n-gram is the number its code points make, so a whole text is counted by one sort.

The profiles are fitted on a sample of labelled rows, about ``SAMPLE`` per language, chosen by a hash of the id; counts
are summed per partition before they are shuffled.  They are ``PROFILE`` rows per language and come to the driver.

Rules: a null text, and one without a letter, is ``und`` with score 0, as is every text when nothing was learned; the
score is one less the share of the largest possible distance; ties between languages go to the first by code point,
ties between n-grams to the smaller number; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = 3  # longest n-gram: three code points fit one 64-bit number
PROFILE = 400  # n-grams of a profile
SAMPLE = 3000  # labelled rows per language, about
STRETCH = 1_000_000  # characters of a long text that are counted at once
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a text as numbers, ascending, and how often each occurs; none without a letter."""
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not c.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.concatenate(([0], c, [0])).astype(np.int64)
    c = c[(c != 0) | (np.concatenate(([1], c[:-1])) != 0)]  # one blank per run
    parts = []
    for low in range(0, len(c), STRETCH):  # n-grams by where they start
        piece = c[low : low + STRETCH + ORDER - 1]
        acc = piece[:STRETCH]
        grams = [acc[acc != 0]]
        for k in range(1, ORDER):
            acc = (acc[: len(piece) - k] << 21) | piece[k : k + len(acc)]
            grams.append(acc)
        parts.append(np.unique(np.concatenate(grams), return_counts=True))
    return parts[0] if len(parts) == 1 else _merged(parts)


def _top(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    if len(counts) > 4 * PROFILE:
        least = np.partition(counts, -PROFILE)[-PROFILE]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.argsort(-counts, kind="stable")[:PROFILE]]


class Profiles:
    """Languages in order, and each n-gram's rank in every language's profile."""

    def __init__(self, ranked: dict[str, list[int]]):
        self.languages = sorted(ranked)
        self.grams = np.array(sorted({g for grams in ranked.values() for g in grams}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int64)  # the last row: in no profile
        for k, language in enumerate(self.languages):
            grams = np.array(ranked[language], np.int64)
            self.ranks[np.searchsorted(self.grams, grams), k] = np.arange(len(grams))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        own = _top(*ngram_counts(text))
        if not len(own):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at[self.grams[at] != own] = len(self.grams)
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return self.languages[best], 1 - float(apart[best]) / (len(own) * PROFILE)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and n-gram of a partition."""
    held: dict[str, list] = {}
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            parts = held.setdefault(language, [])
            parts.append(ngram_counts(text.as_py()))
            if len(parts) == 200:
                held[language] = [_merged(parts)]
    for language, parts in held.items():
        grams, counts = _merged(parts)
        yield pa.RecordBatch.from_arrays([pa.array([language] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    grams, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)


def drawn(column: str, share: float) -> Column:
    """True for that share of the ids, however small, by a 64-bit hash."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(column, F.lit(7)) < F.lit(int(share * 2.0**64) - (1 << 63)).cast("bigint")


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Profiles:
    """Profiles from ``labelled`` (``doc_id``, ``text``, ``lang``); rows without a text or language are left out."""
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    # One number per language.
    share = {r["lang"]: min(1.0, sample / r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return Profiles({})
    chosen = None
    for language, part in share.items():
        one = (F.col("lang") == language) & drawn("doc_id", part)
        chosen = one if chosen is None else chosen | one
    counts = rows.where(chosen).select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE).orderBy("lang", "rank").collect()
    ranked: dict[str, list[int]] = {language: [] for language in share}
    for r in top:
        ranked[r["lang"]].append(r["gram"])
    return Profiles(ranked)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of each whole ``text`` (existing columns of these names are replaced)."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    from pyspark.sql import types as T

    rows = docs.select(*keep)
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)
