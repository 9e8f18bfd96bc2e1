"""Analyses of one security; ``ticker=None`` runs them for every security at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import day, pct_change, round_half_away
from marketloom.operators import timeseries as ts
from marketloom.plans.common import (
    BENCHMARK,
    DEFAULT_START,
    DEFAULT_TICKER,
    Tables,
    between,
    dated,
    labelled,
    of_ticker,
    stock_returns,
    ticker_key,
    with_benchmark,
    with_ticker,
)

ROLLING_ROWS = 30
ROLLING_DAYS = 30
EVENT_DAYS = 7


def _until(tables: Tables, ticker, end) -> DataFrame:
    """Prices up to the end of a range: what a look-back that may precede it can reach."""
    return dated(of_ticker(tables, "Price", ticker), "trade_date", None, end)


def close_series(tables: Tables, ticker=DEFAULT_TICKER, start=DEFAULT_START, end=None) -> DataFrame:
    """Closing prices in a date range."""
    rows = dated(of_ticker(tables, "Price", ticker), "trade_date", start, end)
    return labelled(tables, rows, ticker, ["trade_date"], ["trade_date", F.col("close").cast("double").alias("close")])


def daily_return(tables: Tables, ticker=DEFAULT_TICKER, start=DEFAULT_START, end=None) -> DataFrame:
    """Close and change from the previous trading day, which may precede the range."""
    rows = (
        ts.with_previous(_until(tables, ticker, end), "close", ["security_id"], ["trade_date"], "prev_close")
        .filter(F.col("prev_close").isNotNull() & between("trade_date", start, end))
        .withColumn("daily_return_pct", round_half_away(pct_change("close", "prev_close"), 2))
    )
    columns = ["trade_date", F.col("close").cast("double").alias("close"), "daily_return_pct"]
    return labelled(tables, rows, ticker, ["trade_date"], columns)


def rolling_volatility(tables: Tables, ticker=DEFAULT_TICKER, start=DEFAULT_START, end=None) -> DataFrame:
    """Annualised sample deviation over 30 returns, all taken inside the range."""
    inside = dated(of_ticker(tables, "Price", ticker), "trade_date", start, end)
    returns = ts.with_daily_return(inside).filter(F.col("ret").isNotNull())
    # Deviations are named before they are rounded, which uses them several times.
    moved = returns.withColumn("dev", ts.rolling_rows(F.stddev_samp, "ret", ROLLING_ROWS))
    rows = moved.withColumn("ann_vol_pct", ts.annual_vol_pct(F.col("dev")))
    return labelled(tables, rows, ticker, ["trade_date"], ["trade_date", "ann_vol_pct"])


def rolling_volatility_calendar(tables: Tables, ticker=DEFAULT_TICKER, start=DEFAULT_START, end=None) -> DataFrame:
    """Annualised population deviation of the returns dated within 30 days.

    Frames and predecessors may precede the range.
    """
    rows = (
        ts.with_daily_return(_until(tables, ticker, end))
        .withColumn("dev", ts.rolling_days(F.stddev_pop, "ret", ROLLING_DAYS))
        .withColumn("rolling_vol_pct", ts.annual_vol_pct(F.col("dev")))
        .filter(between("trade_date", start, end))
    )
    return labelled(tables, rows, ticker, ["trade_date"], ["trade_date", "rolling_vol_pct"])


def iv_term_structure(tables: Tables, ticker=DEFAULT_TICKER) -> DataFrame:
    """Implied volatility by expiry and type for contracts whose ticker starts with the text.

    ``%`` and ``_`` in the text act as wildcards; an empty text takes every contract.
    """
    pattern = f"{ticker.strip().upper()}%"
    listed = tables["Security"].filter(ticker_key(tables["Security"]).like(pattern)).select("security_id")
    return (
        tables["Option_Contract"]
        .join(listed, "security_id")
        .groupBy("expiration_date", "option_type")
        .agg(
            F.avg(F.col("implied_volatility").cast("double")).alias("iv"),
            F.sum("open_interest").alias("total_oi"),
            F.count("*").alias("contracts"),
        )
        .orderBy("expiration_date", "option_type")
        .select(
            "expiration_date",
            "option_type",
            round_half_away(F.col("iv") * F.lit(100.0), 2).alias("avg_iv_pct"),
            "total_oi",
            "contracts",
        )
    )


def iv_active(tables: Tables, ticker=DEFAULT_TICKER, as_of=None) -> DataFrame:
    """Implied volatility of unexpired contracts listed under exactly this ticker (None: any)."""
    rows = of_ticker(tables, "Option_Contract", ticker)
    iv = F.col("implied_volatility").cast("double")
    return (
        rows.filter(F.col("expiration_date") >= day(as_of))
        .groupBy("expiration_date", "option_type")
        .agg(
            F.count("security_id").alias("contract_count"),
            round_half_away(F.avg(iv), 4).alias("avg_iv"),
            round_half_away(F.min(iv), 4).alias("min_iv"),
            round_half_away(F.max(iv), 4).alias("max_iv"),
        )
        .orderBy("expiration_date", "option_type")
    )


def _actions_with_prices(tables: Tables, ticker) -> DataFrame:
    legs = [
        ts.Leg("price_on_date"),
        ts.Leg("price_7d_before", shift_days=-EVENT_DAYS),
        ts.Leg("price_7d_after", "forward", EVENT_DAYS),
    ]
    return ts.join_asof(
        of_ticker(tables, "Corporate_Action", ticker),
        of_ticker(tables, "Price", ticker),
        legs,
        by=["security_id"],
        left_on="action_date",
        right_on="trade_date",
        value="close",
    )


def _as_double(*names):
    return [F.col(n).cast("double").alias(n) for n in names]


def action_impact(tables: Tables, ticker=DEFAULT_TICKER) -> DataFrame:
    """Price on each action date and a week either side, with both changes; newest first."""
    rows = (
        _actions_with_prices(tables, ticker)
        .withColumn("chg_pre_pct", round_half_away(pct_change("price_on_date", "price_7d_before"), 2))
        .withColumn("chg_aft_pct", round_half_away(pct_change("price_7d_after", "price_on_date"), 2))
    )
    columns = [
        "action_date",
        "action_type",
        *_as_double("amount", "price_on_date", "price_7d_before", "price_7d_after"),
        "chg_pre_pct",
        "chg_aft_pct",
    ]
    return labelled(tables, rows, ticker, [F.desc("action_date")], columns)


def action_impact_span(tables: Tables, ticker=DEFAULT_TICKER) -> DataFrame:
    """The same prices with the change over the whole fortnight; oldest first."""
    rows = _actions_with_prices(tables, ticker).withColumn(
        "pct_change_over_event", round_half_away(pct_change("price_7d_after", "price_7d_before"), 2)
    )
    columns = [
        "action_type",
        "action_date",
        *_as_double("amount", "price_7d_before", "price_on_date", "price_7d_after"),
        "pct_change_over_event",
    ]
    return labelled(tables, rows, ticker, ["action_date"], columns)


def _return_vs_benchmark(tables: Tables, ticker, start, end, benchmark) -> DataFrame:
    own = stock_returns(of_ticker(tables, "Price", ticker), start, end)
    return with_benchmark(tables, own, start, end, benchmark).select(
        "security_id",
        round_half_away("total_return", 2).alias("stock_return_pct"),
        round_half_away("bench_return", 2).alias("spy_return_pct"),
        round_half_away(F.col("total_return") - F.col("bench_return"), 2).alias("excess_return_pct"),
    )


def return_vs_benchmark(
    tables: Tables, ticker=DEFAULT_TICKER, start=DEFAULT_START, end=None, benchmark=BENCHMARK
) -> DataFrame:
    """Total return next to the benchmark's; empty when either has no price at a bound."""
    rows = _return_vs_benchmark(tables, ticker, start, end, benchmark)
    return rows.drop("security_id") if ticker is not None else with_ticker(tables, rows).drop("security_id")


def return_vs_benchmark_named(
    tables: Tables, ticker=DEFAULT_TICKER, start=DEFAULT_START, end=None, benchmark=BENCHMARK
) -> DataFrame:
    """The same with the ticker."""
    rows = with_ticker(tables, _return_vs_benchmark(tables, ticker, start, end, benchmark))
    return rows.select("ticker", "stock_return_pct", "spy_return_pct", "excess_return_pct")


def snapshot_trend(tables: Tables, ticker=DEFAULT_TICKER) -> DataFrame:
    """Valuation measures per snapshot, market cap in billions."""
    rows = of_ticker(tables, "Financial_Snapshot", ticker)
    cap = round_half_away(F.col("market_cap").cast("double") / F.lit(1e9), 2).alias("market_cap_b")
    columns = ["snapshot_date", *_as_double("pe_ratio", "eps", "beta"), cap]
    return labelled(tables, rows, ticker, ["snapshot_date"], columns)


def snapshot_measures(tables: Tables, ticker=DEFAULT_TICKER) -> DataFrame:
    """Valuation measures per snapshot without market cap."""
    rows = of_ticker(tables, "Financial_Snapshot", ticker)
    return labelled(tables, rows, ticker, ["snapshot_date"], ["snapshot_date", *_as_double("pe_ratio", "eps", "beta")])
