"""Small inputs with the odd cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, size long, label string, family long, bytes long, hash string, score string"
EXTRA = (7, 7, "x", 7, 7, "h", "s")


def words(seed: int, n: int, stock: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(stock)}" for _ in range(n)]


def odd_texts() -> list[tuple]:
    base = " ".join(words(1, 60))
    near = base.replace(base.split()[30], "other", 1)
    texts = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, base.upper() + "\n\t", "en", None),
        (5, None, "en", "a"), (6, "", None, "b"), (7, " \n\t ", "de", "b"), (8, "a b", "de", "a"), (9, "A  b", "de", "a"),
        (10, "12 34 !!", None, None), (None, base, "en", "a"), (None, None, None, None), (11, "same", "fr", "c"), (11, "same", "fr", "c"),
        (12, "same id, first text", "fr", "c"), (12, "same id, second text", "fr", "c"), (13, "é ß ñ 日本   x", "es", ""),
        (14, " ".join(words(2, 30000)), "en", "a"), (15, "x" * 200_000, "en", "b"), (16, "<|endoftext|> 'tis  a\r\ntest", "en", "d"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in texts]


def frame(spark, rows=None):
    return spark.createDataFrame(odd_texts() if rows is None else rows, SCHEMA)


def documents(spark, texts: list[tuple]):
    """Rows of (doc_id, text) or (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*t, *(None,) * (4 - len(t)), None if t[1] is None else len(t[1])) for t in texts], "doc_id long, text string, lang string, source string, n_chars long")
