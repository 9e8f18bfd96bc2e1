"""Spelling variant grouping: words that are one edit apart, found by scanning sorted rotations.

**Rotations.** A word of ``L`` characters is marked with a terminator; its rotations are the ``L + 1`` ways of starting
inside the marked word and going round.  Take the character ``a`` out of ``x a y``: the rotation that begins behind it
reads ``y END x a``, so all words that have *some* character (or none) at that place have a rotation with the prefix
``y END x``, which skips the edited character.  A replacement is another last character behind the same prefix, an
insertion or deletion is the rotation that ends with it.  The rotations are dealt out and sorted by these prefixes, and
the rows of one prefix are one group: at most one word for each character of the alphabet and one for none.

**Scan.** All words of a group are one edit from each other, so no pair has to be written: each word of a group gets the
number of the others and the best of them, which are the first or second of the group.  Two words meet in exactly one
group if they differ by a replacement.  If one lacks a character of the other's run of equal characters, they meet at
each place of the run; only the first place counts.

**Groups.** A word's form is its best neighbour if that is often enough; forms are followed to the end by pointer
doubling.  A form occurs ``factor`` times as often as its word, so chains are short and have no rounds.

Rules: words that hold the terminator U+0000 take no part; null words and null texts hold nothing; a null id counts as
empty text in the hash; repeated rows count as often as they stand there; ties go to the smaller word in code-point order;
other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import stored

END = "\u0000"
LEAST_CHARS, LEAST_COUNT = 6, 5
FACTOR = 5  # a form occurs at least so many times as often as its word
SLIP = 199  # of so many occurrences, by hash, one loses a character


def corpus_words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """Words of the texts (``doc_id``, ``text``) with their number of occurrences: word, n.

    A word is a run of letters; occurrences whose hash of id and word is divisible by ``SLIP`` lose one character.  No
    shorter run can become a word, so runs below the least length are left out at once.
    """
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    runs = F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{least_chars},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.char_length("run").cast("bigint")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = found.select(F.when(F.pmod(h, F.lit(SLIP)) == 0, short).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """Rows ``prefix``, ``edited`` (the skipped character, empty for the whole rotation), ``first`` (of its run), word, n."""
    step = F.explode(F.sequence(F.lit(0), 2 * F.char_length("word"))).alias("step")
    at = F.shiftright("step", 1)
    skips = F.col("step").bitwiseAND(F.lit(1)) == 1
    behind = F.substring("word", at + F.when(skips, 2).otherwise(1), F.char_length("word"))
    before = F.substring("word", F.lit(1), at)
    edited = F.when(skips, F.substring("word", at + 1, F.lit(1))).otherwise(F.lit(""))
    rows = words.where(~F.contains("word", F.lit(END))).select("word", "n", step)
    rows = rows.select(F.concat(behind, F.lit(END), before).alias("prefix"), edited.alias("edited"), F.substring(before, -1, 1).alias("left"), "word", "n")
    return rows.select("prefix", "edited", ((F.col("edited") != "") & (F.col("edited") != F.col("left"))).alias("first"), "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """For each of the distinct ``words`` (word, n) with a word one edit away: word, n_near, near, near_n (the best of them)."""
    by = Window.partitionBy("prefix").orderBy(F.desc("n"), "word")
    group = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def number(test: Column) -> Column:
        return F.sum(test.cast("bigint")).over(group)

    entry = F.struct("n", "word")
    rows = rotations(words).select(
        "word", "edited", "first",
        number(F.col("edited") == "").alias("whole"),
        number(F.col("edited") != "").alias("replaced"),
        number(F.col("first")).alias("longer"),
        F.when(F.row_number().over(by) > 1, F.first(entry).over(group)).otherwise(F.nth_value(entry, 2).over(group)).alias("best"),
    )
    others = F.when(F.col("edited") == "", F.col("longer")).otherwise(F.col("replaced") - 1 + F.when(F.col("first"), F.col("whole")).otherwise(0))
    rows = rows.where("best is not null").select("word", others.alias("others"), (-F.col("best.n")).alias("order"), F.col("best.word").alias("near"))
    best = rows.groupBy("word").agg(F.sum("others").alias("n_near"), F.min(F.struct("order", "near")).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.order")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form), without rounds, followed to the last: word, root.  Each turn doubles the steps."""
    links = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_groups(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """Distinct ``words`` (word, n) with their spelling groups: word, n, n_near, form, form_n, root."""
    words = stored(words.select("word", F.col("n").cast("bigint").alias("n")).where("word is not null"))
    near = words.join(neighbours(words), "word", "left").withColumn("is_form", F.coalesce(F.col("near_n") >= factor * F.col("n"), F.lit(False)))
    rows = stored(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.expr("if(is_form, near, null)").alias("form"), F.expr("if(is_form, near_n, null)").alias("form_n"),
    ))
    ends = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
