"""Surrogate keys and dimension lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges are cut at every SAMPLED-th key of a sample; so many ranges at most.
_SAMPLED = 16
_MOST_RANGES = 4096


def _bounds(keys: DataFrame, ranges: int) -> Column:
    """Cut points of a column ``__key``, as a scalar subquery: a sorted array of at most ``ranges`` keys.

    The sample holds the keys of smallest hash, so it follows from the data alone:
    every evaluation gives the same bounds, however the rows are partitioned.
    """
    sample = keys.orderBy(F.xxhash64("__key"), "__key").limit(_SAMPLED * ranges)
    keys = sample.agg(F.sort_array(F.collect_list("__key")).alias("keys"))
    return keys.select(F.filter("keys", lambda _, i: i % _SAMPLED == _SAMPLED - 1).alias("bounds")).scalar()


def _range_of(bounds: Column, key: Column, ranges: int = _MOST_RANGES) -> Column:
    """Number of bounds (at most ``ranges``) up to the key, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(ranges.bit_length()))])

    def step(at, size):
        further = (at + size <= F.size(bounds)) & (F.get(bounds, at + size - 1) <= key)
        return F.when(further, at + size).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _with_range(rows: DataFrame, bounds: Column, key: Column, ranges: int = _MOST_RANGES) -> DataFrame:
    """Adds the number of ``_range_of`` as ``__range``.

    One column per step of the search: plain comparisons are compiled, while a
    higher-order function is interpreted for every row. Steps are SQL texts, as
    each operator of a column made in Python costs several calls to the JVM.

    The number is generated at the end: Spark follows a join key down to a scan
    by putting each step into the next, and as a step uses the one before it
    three times, that took memory and time of the driver by powers of three.
    """
    placed = rows.withColumns({"__bounds": bounds, "__key": key, "__range": F.lit(0)})
    for k in reversed(range(ranges.bit_length())):
        at = f"__range + {1 << k}"
        further = f"{at} <= size(__bounds) AND get(__bounds, {at} - 1) <= __key"
        placed = placed.withColumn("__range", F.expr(f"CASE WHEN {further} THEN {at} ELSE __range END"))
    return placed.select(*rows.columns, F.explode(F.array("__range")).alias("__range"))


def assign_ids(df: DataFrame, order: list, name: str, start=1, partitions: int | None = None) -> DataFrame:
    """Dense ids in the given order, without gathering the rows into one task.

    The order is cut into ranges at bounds taken from a sample. Rows are numbered
    inside their range and shifted by the sizes of the ranges before it, which
    are a small table joined to them. Which range a row belongs to follows from
    the data alone, so nothing has to be kept between the passes, and no job runs
    before the result is asked for. ``order`` must be unique for the ids to be
    stable.
    """
    ranges = min(_MOST_RANGES, 2 * (partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    key = F.struct(*order)
    placed = _with_range(df, _bounds(df.select(key.alias("__key")), ranges), key, ranges)
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__n"))
    # One row with all sizes: few thousand numbers, summed in place.
    listed = sizes.agg(F.sort_array(F.collect_list(F.struct("__range", "__n"))).alias("sizes"))
    sums = F.expr("aggregate(sizes, array(bigint(0)), (done, x) -> array_append(done, element_at(done, -1) + x.__n))")
    offsets = (
        listed.select("sizes", sums.alias("sums"))
        .select(F.inline(F.arrays_zip("sizes", "sums")))
        .filter(F.col("sizes").isNotNull())
        .select("sizes.__range", F.col("sums").alias("__before"))
    )
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order)).alias("__within")
    numbered = placed.select("*", within).join(offsets, "__range")
    base = start if isinstance(start, Column) else F.lit(start)
    return numbered.select((base + F.col("__before") + F.col("__within") - 1).cast("long").alias(name), *df.columns)


def next_id(df: DataFrame, column: str) -> Column:
    """The next free id of a table, as a scalar subquery."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("long").alias("next")).scalar()


def rows_of(rows: DataFrame, keys: DataFrame, key: str = "security_id") -> DataFrame:
    """Rows whose key is among ``keys``, which may be few or many.

    A semi join picks the rows; the smallest and largest key, as scalar
    subqueries, reach the file scan before it, so row groups are skipped.
    """
    return range_of(rows, keys, key).join(keys.select(key), key, "left_semi")


def range_of(rows: DataFrame, keys: DataFrame, key: str = "security_id") -> DataFrame:
    """Rows between the smallest and the largest key, for a join on the key that follows."""
    keys = keys.select(key)
    return rows.filter(F.col(key).between(keys.agg(F.min(key)).scalar(), keys.agg(F.max(key)).scalar()))


#: Tasks that a large sort or aggregation is spread over where the session has few shuffle partitions.
TASKS = 96


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows shuffled by keys for a step that holds a task's rows in memory.

    A session with as many shuffle partitions as cores would give each core one huge task; several
    times as many, up to ``TASKS``, hold a fraction each. More partitions than that are left as they are.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(min(8 * n, TASKS), *keys) if n < TASKS else rows


#: Parts that the rows of a key are dealt into before a join with unique rows.
SLOTS = 16


def join_dealt(rows: DataFrame, unique: DataFrame, key: str, deal_by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row per key of ``unique``, however many rows a key has.

    The rows of a key are dealt into slots by another column, and the unique row
    is repeated for each slot.
    """
    slots = F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("__slot")
    dealt = rows.withColumn("__slot", F.pmod(F.xxhash64(deal_by), F.lit(SLOTS)).cast("int"))
    return dealt.join(unique.select("*", slots), [key, "__slot"], how).drop("__slot")
