"""Time-series operators over keyed, dated relations.

Windows here partition by a series key whose (key, date) pair is unique, so one
group never holds more rows than there are calendar days, however large the
table is. Relations without that guarantee are reduced to distinct dates first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import day, ratio, round_half_away
from marketloom.operators.keys import spread

TRADING_DAYS = 252.0


def with_previous(df: DataFrame, value: str, by: list[str], order: list[str], name: str) -> DataFrame:
    """Adds the value of the preceding row of the same series."""
    series = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.lag(value).over(series))


def with_daily_return(prices: DataFrame) -> DataFrame:
    """Adds ``prev_close`` and ``ret``; the first row of a series has NULL in both.

    Filters on the date placed before this call bound the predecessor, filters
    placed after it do not.
    """
    lagged = with_previous(prices, "close", ["security_id"], ["trade_date"], "prev_close")
    change = F.col("close") - F.col("prev_close")
    return lagged.withColumn("ret", ratio(change, "prev_close"))


def rolling_rows(agg, value: str, rows: int, by: str = "security_id", order: str = "trade_date") -> Column:
    """Aggregate over the current row and the ``rows - 1`` before it."""
    frame = Window.partitionBy(by).orderBy(order).rowsBetween(1 - rows, 0)
    return agg(value).over(frame)


def rolling_days(agg, value: str, days: int, by: str = "security_id", order: str = "trade_date") -> Column:
    """Aggregate over the rows dated within ``days`` calendar days up to this one."""
    frame = Window.partitionBy(by).orderBy(F.unix_date(order)).rangeBetween(-days, 0)
    return agg(value).over(frame)


def annual_vol_pct(stddev: Column) -> Column:
    return round_half_away(stddev * F.sqrt(F.lit(TRADING_DAYS)) * F.lit(100.0), 2)


def latest_per_key(df: DataFrame, key: str, date: str, values: list[str]) -> DataFrame:
    """Values of the most recent row per key: one aggregation, no self-join.

    ``max_by`` keeps a NULL value of the latest row instead of reaching back.
    """
    picks = [F.max_by(v, date).alias(v) for v in values]
    return df.groupBy(key).agg(F.max(date).alias(date), *picks)


def endpoints_in_range(prices: DataFrame, start, end) -> DataFrame:
    """First close on or after ``start`` and last close on or before ``end``.

    Each bound acts alone, so the first close may lie after the last one. Series
    lacking either are dropped. One aggregation with map-side combine.
    """
    date = F.col("trade_date")
    return (
        prices.groupBy("security_id")
        .agg(
            F.min_by("close", F.when(date >= day(start), date)).alias("first_close"),
            F.max_by("close", F.when(date <= day(end), date)).alias("last_close"),
        )
        .filter(F.col("first_close").isNotNull() & F.col("last_close").isNotNull())
    )


@dataclass(frozen=True)
class Leg:
    """One as-of lookup: the nearest row on one side of the shifted date."""

    name: str
    direction: str = "backward"
    shift_days: int = 0


def join_asof(
    left: DataFrame,
    right: DataFrame,
    legs: list[Leg],
    *,
    by: list[str],
    left_on: str,
    right_on: str,
    value: str,
) -> DataFrame:
    """Adds one column per leg holding the as-of ``value`` of ``right``, or NULL.

    Backward takes the last row at or before the probe, forward the first at or
    after it. All legs share one shuffle of ``right``: probes and rows are merged
    per series, ordered and filled from the nearest row. Probes are distinct
    (key, point) pairs, so a group holds no more rows than there are distinct
    points, even when one key owns most of ``left``. ``right`` must be unique per
    key and point.
    """

    # Rows are kept narrow, since each direction sorts them: a leg is a number (marks have -1, before
    # the probes of their day), the day of a probe follows from its point, and marks don't carry results.
    def probe(number: int, leg: Leg) -> Column:
        at = F.date_add(left_on, leg.shift_days) if leg.shift_days else F.col(left_on)
        return F.struct(F.lit(number).alias("leg"), at.alias("at"))

    usable = F.col(left_on).isNotNull()
    for key in by:
        usable = usable & F.col(key).isNotNull()
    probes = (
        left.select(*by, left_on)
        .filter(usable)
        .distinct()
        .select(*by, F.explode(F.array(*[probe(i, leg) for i, leg in enumerate(legs)])).alias("l"))
        .select(*by, F.col("l.at").alias("at"), F.col("l.leg").alias("leg"))
    )
    marks = right.select(
        *by,
        F.col(right_on).alias("at"),
        F.lit(-1).alias("leg"),
        F.struct(F.col(value).alias("v")).alias("mark"),
    )
    filled = spread(marks.unionByName(probes, allowMissingColumns=True), *by)

    def probes_of(direction: str) -> Column:
        return F.col("leg").isin(*[i for i, leg in enumerate(legs) if leg.direction == direction])

    if any(leg.direction == "backward" for leg in legs):
        before = Window.partitionBy(*by).orderBy("at", "leg").rowsBetween(Window.unboundedPreceding, 0)
        filled = filled.withColumn("backward", F.last("mark", ignorenulls=True).over(before))
        filled = filled.withColumn("backward", F.when(probes_of("backward"), F.col("backward.v")))
    if any(leg.direction == "forward" for leg in legs):
        # Descending order keeps the frame growing, which is linear; a frame
        # that ends at the last row would be evaluated anew for every row.
        after = Window.partitionBy(*by).orderBy(F.desc("at"), "leg").rowsBetween(Window.unboundedPreceding, 0)
        filled = filled.withColumn("forward", F.last("mark", ignorenulls=True).over(after))
        filled = filled.withColumn("forward", F.when(probes_of("forward"), F.col("forward.v")))

    shifts = F.array(*[F.lit(leg.shift_days) for leg in legs])
    day_of = F.date_sub("at", F.get(shifts, F.col("leg"))) if any(leg.shift_days for leg in legs) else F.col("at")
    found = (
        filled.filter(F.col("leg") >= 0)
        .withColumn(left_on, day_of.cast(left.schema[left_on].dataType))
        .groupBy(*by, left_on)
        .agg(*[
            F.max(F.when(F.col("leg") == i, F.col(leg.direction))).alias(leg.name)
            for i, leg in enumerate(legs)
        ])
    )
    return left.join(found, [*by, left_on], "left")
