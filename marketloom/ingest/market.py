"""Cleaning of landed market data: prices, funds, options, fundamentals, actions."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import day, non_zero, year_before
from marketloom.functions.scalar import is_missing
from marketloom.ingest import fixed_values as fixed
from marketloom.ingest.reference import ids_by_ticker
from marketloom.operators import timeseries as ts
from marketloom.operators.keys import assign_ids

HISTORY_YEARS = 3
FULL = "full"
DAILY = "daily"
OHLC = ("open", "high", "low", "close")


def run_mode(date) -> Column:
    """A full sweep on Sundays, the daily set otherwise."""
    return F.when(F.dayofweek(date) == 1, FULL).otherwise(DAILY)


def date_range(start=None, end=None, today=None, env=None) -> tuple[Column, Column]:
    """Price range: explicit dates before ``PRICE_START``/``PRICE_END`` before the default.

    The default ends today and starts three years earlier. Arguments may be
    columns, one range per row; a NULL counts as not given.
    """
    env = os.environ if env is None else env

    def given(value, variable) -> list[Column]:
        return [day(v) for v in (value, env.get(variable) or None) if v is not None]

    first = F.coalesce(*given(start, "PRICE_START"), year_before(today, HISTORY_YEARS))
    last = F.coalesce(*given(end, "PRICE_END"), day(today))
    return first, last


def long_prices(wide: DataFrame, symbols: list[str], fields: list[str], keys=("trade_date",)) -> DataFrame:
    """One row per symbol and key with a close, from columns named ``<symbol>_<field>``.

    Runs inside each row: no shuffle, one pass, whatever the number of rows.
    """
    cells = [
        F.struct(F.lit(s).alias("symbol"), *[F.col(f"`{s}_{f}`").alias(f) for f in fields]) for s in symbols
    ]
    rows = wide.select(*keys, F.inline(F.array(*cells)))
    return rows.filter(~is_missing(F.col("close").cast("double"))).select("symbol", *keys, *fields)


def _number(column) -> Column:
    value = F.col(column).cast("double")
    return F.when(~is_missing(value), value)


def clean_prices(raw: DataFrame, securities: DataFrame) -> DataFrame:
    """Prices of known securities: no missing close, four digits, whole volume with 0 for missing."""
    ids = ids_by_ticker(securities).withColumnRenamed("ticker", "symbol")
    return (
        raw.filter(~is_missing(F.col("close").cast("double")))
        .join(ids, "symbol")
        .select(
            "security_id",
            F.to_date("trade_date").alias("trade_date"),
            *[F.round(_number(c), 4).cast("decimal(12,4)").alias(c) for c in OHLC],
            F.coalesce(_number("volume"), F.lit(0.0)).cast("long").alias("volume"),
        )
    )


def fund_metadata(funds: DataFrame, info: DataFrame) -> DataFrame:
    """Name and expense ratio per fund, with fallbacks; empty text and zero count as missing.

    ``funds``: symbol, name_fallback, expense_fallback. ``info``: symbol,
    long_name, short_name, expense_a, expense_b as fractions.
    """

    def text(column):
        return F.nullif(F.col(column), F.lit(""))

    live = F.coalesce(non_zero("expense_a"), non_zero("expense_b"))
    return funds.join(info, "symbol", "left").select(
        "symbol",
        F.coalesce(text("long_name"), text("short_name"), F.col("name_fallback")).alias("fund_name"),
        F.coalesce(F.round(live * F.lit(100.0), 4), F.col("expense_fallback").cast("double")).alias("expense_ratio"),
    )


def nearest_strikes(targets: DataFrame, chain: DataFrame) -> DataFrame:
    """Volatility and open interest of the listed strike nearest to each target.

    Same underlying, expiry and type; of two equally near strikes the lower. No
    listing at all gives the fallbacks; a missing open interest counts as 0, a
    missing volatility falls back alone. Found with two as-of lookups, so targets
    and listings are never paired up.
    """
    group = ["underlying_id", "expiration_date", "option_type"]
    quote = F.struct("implied_volatility", "open_interest")
    listed = chain.groupBy(*group, "strike").agg(F.min(quote).alias("quote")).withColumn(
        "hit", F.struct("strike", "quote")
    )
    legs = [ts.Leg("under"), ts.Leg("over", "forward")]
    rows = ts.join_asof(targets, listed, legs, by=group, left_on="strike", right_on="strike", value="hit")
    down = F.col("strike") - F.col("under.strike")
    up = F.col("over.strike") - F.col("strike")
    hit = F.when(F.col("over").isNull() | (down <= up), F.col("under")).otherwise(F.col("over"))
    return (
        rows.withColumn("near", hit)
        .withColumn("iv", F.round(F.col("near.quote.implied_volatility").cast("double"), 4))
        .select(
            *targets.columns,
            F.coalesce(F.when(~F.isnan("iv"), F.col("iv")), F.col("iv_fallback").cast("double")).alias(
                "implied_volatility"
            ),
            F.when(F.col("near").isNull(), F.col("oi_fallback"))
            .otherwise(F.coalesce("near.quote.open_interest", F.lit(0)))
            .cast("int")
            .alias("open_interest"),
        )
    )


def fundamentals_scope(constituents: DataFrame, mode: str, curated=fixed.DAILY_SYMBOLS) -> DataFrame:
    """Symbols whose fundamentals are refreshed: all, or the curated ones among them."""
    if mode == FULL:
        return constituents.select("symbol")
    if isinstance(curated, DataFrame):
        return constituents.select("symbol").join(curated.select("symbol"), "symbol", "left_semi")
    return constituents.select("symbol").filter(F.col("symbol").isin(*curated))


def clean_snapshots(scope: DataFrame, info: DataFrame, securities: DataFrame, end) -> DataFrame:
    """One snapshot per symbol in scope at the end date; zero or missing measures are NULL."""
    ids = securities.select(F.col("ticker").alias("symbol"), "security_id")
    return (
        scope.join(ids, "symbol")
        .join(info, "symbol", "left")
        .select(
            "symbol",
            "security_id",
            day(end).alias("snapshot_date"),
            F.col("market_cap").cast("long").alias("market_cap"),
            F.round(non_zero("trailing_pe"), 2).alias("pe_ratio"),
            F.round(non_zero("trailing_eps"), 4).alias("eps"),
            F.round(non_zero("beta"), 4).alias("beta"),
        )
    )


def snapshot_table(snapshots: DataFrame) -> DataFrame:
    """Snapshots numbered in symbol order."""
    return assign_ids(snapshots, ["symbol"], "snapshot_id").drop("symbol")


def classify_actions(raw: DataFrame, scope: DataFrame, securities: DataFrame, start, end) -> DataFrame:
    """Dividends and splits of the symbols in scope within the range, with sequential ids.

    A split above 1 is a split, any other a reverse split. Ids run by symbol,
    dividends before splits, then by date.

    The symbols of a whole market are shuffled, not broadcast: a file of numbers
    looks small to the planner, and the driver would hold every symbol made of
    them. The ids read their rows three times, and all three share this shuffle.
    """
    ids = securities.select(F.col("ticker").alias("symbol"), "security_id")
    listed = ids.join(scope.select("symbol").hint("shuffle_hash"), "symbol", "left_semi")
    dividend = F.col("kind") == "dividend"
    rows = (
        raw.filter(F.col("action_date").between(day(start), day(end)))
        .join(listed.hint("shuffle_hash"), "symbol")
        .select(
            "symbol",
            F.when(dividend, 0).otherwise(1).alias("turn"),
            "security_id",
            "action_date",
            F.when(dividend, "dividend")
            .when(F.col("value").cast("double") > 1, "split")
            .otherwise("reverse_split")
            .alias("action_type"),
            F.round(F.col("value").cast("double"), 6).cast("decimal(14,6)").alias("amount"),
        )
    )
    return assign_ids(rows, ["symbol", "turn", "action_date", "amount"], "action_id").drop("symbol", "turn")
