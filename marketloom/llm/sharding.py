"""Sharding by extendible hashing.

A row's bucket is a prefix of the bits of its hash.  The directory starts with so many bits that an average bucket is
within the byte limit; only buckets over the limit are split on one more bit, until every one fits.  Rows with equal
hashes can't be told apart by any bit: such a bucket stays whole when it holds nothing else, and is marked.

The directory is worked out on sums: bytes per prefix of a few bits more than the directory is likely to need.  These
sums are small beside the rows, and each round halves only the buckets still too large.  Rows of prefixes that are too
large even then (a few long texts) go on with more bits, by themselves, down to whole hashes.  Everything is DataFrame
work; the driver sees one number a round.

Rules: a row's hash is md5 over its id, a slash and the text's md5, its bytes are those of the text in UTF-8; a null
id or text counts as an empty one; an empty table has no shards; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored

BITS = 60  # of the hash that are used: fifteen hexadecimal digits
FINE = 6  # bits of the summed prefixes beyond those of an average bucket


def row_hash(key: str = "doc_id", text: str = "text") -> Column:
    """The first ``BITS`` bits of md5, as a bigint."""
    own = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(own.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _prefix(column: str, bits: int, of: int) -> Column:
    """The leading ``bits`` of a number of ``of`` bits."""
    return F.shiftright(column, of - bits)


def _split(sums: DataFrame, width: int, depth: int, limit: int) -> tuple[list[DataFrame], DataFrame]:
    """Directory entries (``prefix``, ``depth``, ``bytes``, ``oversized``) over sums of ``width`` bits, and the sums that
    belong to buckets still over the limit at that width."""
    found, rest = [], sums
    while True:
        buckets = rest.withColumn("bucket", _prefix("prefix", depth, width)).groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
        buckets = stored(buckets)
        fits = (F.col("bytes") <= limit) | (F.col("low") == F.col("high"))
        found.append(buckets.where(fits).select(F.col("bucket").alias("prefix"), F.lit(depth).alias("depth"), "bytes", (F.col("bytes") > limit).alias("oversized")))
        over = buckets.where(~fits)
        if over.isEmpty():
            return found, rest.limit(0)
        rest = rest.withColumn("bucket", _prefix("prefix", depth, width)).join(over.select("bucket"), "bucket", "left_semi").drop("bucket")
        rest = stored(rest)
        if depth == width:
            return found, rest
        depth += 1


def shard(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: the key, hash, bytes, and the shard as a text of bits, its depth, bytes and mark."""
    rows = docs.select(F.col(key), row_hash(key, text).alias("hash"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes"))
    rows = stored(rows)
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))))
    width = min(BITS, depth + FINE)

    fine = rows.withColumn("prefix", _prefix("hash", width, BITS)).groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    found, rest = _split(stored(fine), width, depth, limit)
    if width < BITS and not rest.isEmpty():
        own = rows.withColumn("prefix", _prefix("hash", width, BITS)).join(rest.select("prefix"), "prefix", "left_semi")
        own = own.groupBy(F.col("hash").alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        found += _split(stored(own), BITS, width + 1, limit)[0]
    directory = found[0]
    for part in found[1:]:
        directory = directory.union(part)
    directory = stored(directory.withColumnRenamed("bytes", "shard_bytes"))

    # Entries of few bits are written out to all summed prefixes below them; rows below deeper ones look up each depth.
    free = F.lit(width) - F.col("depth")
    ranges = F.expr(f"sequence(shiftleft(prefix, {width} - depth), shiftleft(prefix + 1, {width} - depth) - 1)")
    shallow = directory.where(free >= 0).withColumn("fine", F.explode(ranges))
    # Written out, the directory is much larger than its file, which Spark would judge it by: it isn't broadcast.
    at = rows.withColumn("fine", _prefix("hash", width, BITS)).join(shallow.hint("merge"), "fine").drop("fine")
    for depth in sorted(r[0] for r in directory.where(free < 0).select("depth").distinct().collect()):
        deep = directory.where(F.col("depth") == depth)
        at = at.unionByName(rows.withColumn("prefix", _prefix("hash", depth, BITS)).join(deep, "prefix"))
    bits = F.when(F.col("depth") > 0, F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))).otherwise(F.lit(""))
    return at.select(F.col(key), "hash", "bytes", bits.alias("shard"), "depth", "shard_bytes", "oversized")
