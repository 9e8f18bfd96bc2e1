"""Analyses across a sector; ``sector=None`` leaves the sector open.

Measures are reduced per security, with map-side combine, before they meet the
members of a sector: what crosses the network is one partial row per security,
never the fact rows. Only analyses that need the rows in order restrict them to
the members first; the shuffle on the security that costs is the window's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketloom.functions import ratio, round_half_away, same_text
from marketloom.operators import timeseries as ts
from marketloom.operators.stretches import over_stretches
from marketloom.plans.common import (
    ALL_SECTORS,
    BENCHMARK,
    DEFAULT_MIN_QUARTERS,
    DEFAULT_START,
    Tables,
    dated,
    stock_returns,
    stocks,
    trailing_dividends,
    with_benchmark,
    with_ticker,
)

TOP_VOLATILE = 10
TOP_YIELD = 15
TOP_YIELD_DETAILED = 20
TOP_VOLUME = 10
GROWTH_FRAME = 4

# Lower bounds and labels of the market-cap tiers.
FOUR_TIERS = (
    (200_000_000_000, "Mega Cap (>=200B)"),
    (10_000_000_000, "Large Cap (10-200B)"),
    (2_000_000_000, "Mid Cap (2-10B)"),
)
FOUR_TIERS_REST = "Small Cap (<2B)"
FIVE_TIERS = (
    (200_000_000_000, "Mega Cap (>200B)"),
    (10_000_000_000, "Large Cap (10-200B)"),
    (2_000_000_000, "Mid Cap (2-10B)"),
    (300_000_000, "Small Cap (300M-2B)"),
)
FIVE_TIERS_REST = "Micro Cap (<300M)"


def _tier(cap: Column, tiers, rest: str) -> Column:
    label = F
    for bound, text in tiers:
        label = label.when(cap >= F.lit(bound), text)
    return label.otherwise(rest)


def _mean(total, count) -> Column:
    """Mean from an exact sum, leaving decimals only for the division."""
    return ratio(total, count)


def _of(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of the member securities, co-located for a window over the security."""
    return rows.join(members.select("security_id"), "security_id", "left_semi")


def _latest_snapshots(tables: Tables, members: DataFrame, measures: list[str]) -> DataFrame:
    """Members with the measures of their latest snapshot, whatever those hold."""
    latest = ts.latest_per_key(tables["Financial_Snapshot"], "security_id", "snapshot_date", measures)
    return latest.join(members, "security_id")


def _latest_close(tables: Tables) -> DataFrame:
    return ts.latest_per_key(tables["Price"], "security_id", "trade_date", ["close"]).drop("trade_date")


def sectors(tables: Tables) -> DataFrame:
    return tables["Sector"].select("sector_name").orderBy("sector_name")


def tickers(tables: Tables) -> DataFrame:
    """Searchable universe: stocks by company name, funds by fund name."""
    named = tables["Stock"].join(tables["Company"], "company_id").select("security_id", "company_name")
    return (
        tables["Security"]
        .filter(F.col("security_type").isin("stock", "etf"))
        .join(named, "security_id", "left")
        .join(tables["ETF"].select("security_id", "fund_name"), "security_id", "left")
        .select("ticker", F.coalesce("company_name", "fund_name").alias("company_name"), "security_type")
        .orderBy("ticker")
    )


def _sector_returns(tables: Tables, start, end, benchmark) -> DataFrame:
    members = stocks(tables)
    gains = stock_returns(tables["Price"], start, end)
    by_sector = (
        gains.join(members, "security_id")
        .groupBy("sector_id", "sector_name")
        .agg(F.avg("total_return").alias("mean_return"), F.count("*").alias("stock_count"))
    )
    return with_benchmark(tables, by_sector, start, end, benchmark)


def sector_vs_benchmark(tables: Tables, start=DEFAULT_START, end=None, benchmark=BENCHMARK) -> DataFrame:
    """Mean stock return per sector relative to the benchmark."""
    return (
        _sector_returns(tables, start, end, benchmark)
        .select(
            "sector_name",
            round_half_away("mean_return", 2).alias("sector_return_pct"),
            round_half_away("bench_return", 2).alias("spy_return_pct"),
            round_half_away(F.col("mean_return") - F.col("bench_return"), 2).alias("relative_pct"),
        )
        .orderBy(F.desc("relative_pct"), "sector_name")
    )


def sector_vs_benchmark_counted(tables: Tables, start=DEFAULT_START, end=None, benchmark=BENCHMARK) -> DataFrame:
    """Mean stock return and number of stocks per sector next to the benchmark."""
    return (
        _sector_returns(tables, start, end, benchmark)
        .select(
            "sector_name",
            "stock_count",
            round_half_away("mean_return", 2).alias("avg_return_pct"),
            round_half_away("bench_return", 2).alias("spy_return_pct"),
        )
        .orderBy(F.desc("avg_return_pct"), "sector_name")
    )


def pe_by_industry(tables: Tables, sector=None) -> DataFrame:
    """Mean positive P/E of the latest snapshots per industry."""
    rows = _latest_snapshots(tables, stocks(tables, sector), ["pe_ratio"]).filter(F.col("pe_ratio") > 0)
    return (
        rows.groupBy("industry_id", "industry_name")
        .agg(
            round_half_away(_mean(F.sum("pe_ratio"), F.count("pe_ratio")), 2).alias("avg_pe"),
            F.count_distinct("company_id").alias("companies"),
        )
        .orderBy(F.desc("avg_pe"), "industry_id")
        .drop("industry_id")
    )


def pe_by_industry_min_cap(tables: Tables, sector=None, min_cap=0) -> DataFrame:
    """Mean P/E per industry over latest snapshots of at least a market cap."""
    rows = _latest_snapshots(tables, stocks(tables, sector), ["pe_ratio", "market_cap"]).filter(
        F.col("pe_ratio").isNotNull() & (F.col("market_cap") >= F.lit(min_cap))
    )
    return (
        rows.groupBy("industry_id", "industry_name")
        .agg(
            F.count_distinct("company_id").alias("company_count"),
            round_half_away(_mean(F.sum("pe_ratio"), F.count("pe_ratio")), 2).alias("avg_pe_ratio"),
        )
        .orderBy(F.desc("avg_pe_ratio"), "industry_id")
        .drop("industry_id")
    )


def _with_previous_eps(rows: DataFrame, window: WindowSpec) -> DataFrame:
    return rows.withColumn("prev_eps", F.lag("eps").over(window))


def _with_rises(rows: DataFrame, window: WindowSpec) -> DataFrame:
    rise = F.when(F.col("eps") > F.col("prev_eps"), 1).otherwise(0)
    return rows.withColumn("rises", F.sum(rise).over(window.rowsBetween(1 - GROWTH_FRAME, 0)))


def _best_growth(quarters: DataFrame, windowed) -> DataFrame:
    """Most rises in any frame per company; ``windowed`` applies a function over the company's rows."""
    lagged = windowed(quarters, 1, _with_previous_eps).filter(F.col("prev_eps").isNotNull())
    framed = windowed(lagged, GROWTH_FRAME - 1, _with_rises)
    return framed.groupBy("company_id").agg(F.max("rises").alias("consecutive_qtrs"))


def eps_growth_count(tables: Tables, sector=ALL_SECTORS, min_q=DEFAULT_MIN_QUARTERS) -> DataFrame:
    """Companies whose best four-quarter frame holds at least ``min_q`` EPS rises.

    A frame has four rows, so no company qualifies for more than four. A missing
    EPS is neither a rise nor, for the next row, a base to rise from.

    The quarters of all stocks of a company form one series, worked in stretches
    of limited length.
    """
    quarters = tables["Financial_Snapshot"].join(tables["Stock"], "security_id").select(
        "company_id", "security_id", "snapshot_date", "eps"
    )
    by, order = ["company_id"], ["snapshot_date", "security_id"]

    def in_stretches(rows, look_back, compute):
        return over_stretches(rows, by, order, look_back, compute)

    best = _best_growth(quarters, in_stretches)
    companies = stocks(tables).select("company_id", "company_name", "sector_name").distinct()
    if sector and sector.upper() != ALL_SECTORS:
        companies = companies.filter(same_text("sector_name", F.lit(sector)))
    return (
        best.filter(F.col("consecutive_qtrs") >= max(1, int(min_q)))
        .join(companies, "company_id")
        .orderBy(F.desc("consecutive_qtrs"), "company_id")
        .select("company_name", "sector_name", "consecutive_qtrs")
    )


def eps_growth_strict(tables: Tables, sector=None) -> DataFrame:
    """Companies with five or more snapshots and no EPS stall in the last four.

    A stall is an EPS at or below that of the snapshot just before; a missing
    EPS on either side is none.
    """
    members = stocks(tables, sector)
    snaps = _of(tables["Financial_Snapshot"], members).select("security_id", "snapshot_date", "eps")
    series = ts.with_previous(snaps, "eps", ["security_id"], ["snapshot_date"], "prev_eps")
    newest = Window.partitionBy("security_id").orderBy(F.desc("snapshot_date"))
    recent_stall = (F.row_number().over(newest) <= GROWTH_FRAME) & (F.col("eps") <= F.col("prev_eps"))
    steady = (
        series.withColumn("stall", F.coalesce(recent_stall, F.lit(False)))
        .groupBy("security_id")
        .agg(F.count("*").alias("n"), F.count_if("stall").alias("stalls"))
        .filter((F.col("n") > GROWTH_FRAME) & (F.col("stalls") == 0))
    )
    return (
        with_ticker(tables, steady.join(members, "security_id"))
        .orderBy("company_name", "ticker")
        .select("company_name", "ticker")
    )


def top_volatile(tables: Tables, sector=None, start=DEFAULT_START, end=None) -> DataFrame:
    """Ten stocks with the largest annualised deviation of in-range daily returns."""
    members = stocks(tables, sector).select("security_id", "company_name")
    inside = _of(dated(tables["Price"], "trade_date", start, end), members)
    returns = ts.with_daily_return(inside).filter(F.col("ret").isNotNull()).select("security_id", "ret")
    return (
        returns.join(with_ticker(tables, members), "security_id")
        .groupBy("ticker", "company_name")
        .agg(ts.annual_vol_pct(F.stddev_samp("ret")).alias("ann_vol_pct"))
        .orderBy(F.desc("ann_vol_pct"), "ticker", "company_name")
        .limit(TOP_VOLATILE)
    )


def top_price_stddev(tables: Tables, sector=None, start=DEFAULT_START, end=None) -> DataFrame:
    """Ten stocks with the largest population deviation of the price level."""
    members = stocks(tables, sector).select("security_id", "company_name")
    spread = (
        dated(tables["Price"], "trade_date", start, end)
        .groupBy("security_id")
        .agg(
            round_half_away(F.stddev_pop(F.col("close").cast("double")), 2).alias("price_stddev"),
            F.count("trade_date").alias("trading_days"),
        )
        .join(members, "security_id")
        .orderBy(F.desc("price_stddev"), "security_id")
        .limit(TOP_VOLATILE)
    )
    return (
        with_ticker(tables, spread)
        .orderBy(F.desc("price_stddev"), "security_id")
        .select("ticker", "company_name", "price_stddev", "trading_days")
    )


def _against_industry_mean(rows: DataFrame) -> DataFrame:
    """Adds ``below``: P/E under the mean of its industry.

    The mean is aggregated and joined back: an industry may hold any share of
    the stocks, so it must not become one window partition.
    """
    means = rows.groupBy("industry_id").agg(_mean(F.sum("pe_ratio"), F.count("pe_ratio")).alias("mean_pe"))
    below = F.when(F.col("pe_ratio").cast("double") < F.col("mean_pe"), 1).otherwise(0)
    return rows.join(means, "industry_id").withColumn("below", below)


def below_average_pe(tables: Tables) -> DataFrame:
    """Per industry: mean positive P/E, rows, and the share of rows below that mean."""
    rows = _latest_snapshots(tables, stocks(tables), ["pe_ratio"]).filter(F.col("pe_ratio") > 0)
    share = ratio(F.sum("below"), F.count("*")) * F.lit(100.0)
    return (
        _against_industry_mean(rows)
        .groupBy("industry_id", "industry_name")
        .agg(
            round_half_away(_mean(F.sum("pe_ratio"), F.count("pe_ratio")), 1).alias("avg_pe"),
            F.count("*").alias("total_companies"),
            round_half_away(share, 1).alias("pct_below_avg"),
        )
        .orderBy(F.desc("pct_below_avg"), "industry_id")
        .drop("industry_id")
    )


def below_average_pe_distinct(tables: Tables) -> DataFrame:
    """The same over every known P/E, with distinct companies as the base."""
    rows = _latest_snapshots(tables, stocks(tables), ["pe_ratio"]).filter(F.col("pe_ratio").isNotNull())
    companies = F.count_distinct("company_id")
    return (
        _against_industry_mean(rows)
        .groupBy("industry_id", "industry_name")
        .agg(companies.alias("total_companies"), F.sum("below").alias("below_avg_count"))
        .withColumn(
            "pct_below_avg", round_half_away(ratio("below_avg_count", "total_companies") * F.lit(100.0), 1)
        )
        .orderBy(F.desc("pct_below_avg"), "industry_id")
        .select("industry_name", "total_companies", "below_avg_count", "pct_below_avg")
    )


def _dividend_payers(tables: Tables, members: DataFrame, as_of) -> DataFrame:
    """Members that paid in the past year, with their latest close and yield."""
    paid = trailing_dividends(tables, as_of).filter(F.col("dividends") > 0)
    payers = members.join(paid, "security_id")
    return payers.join(_latest_close(tables), "security_id").withColumn(
        "div_yield_pct", round_half_away(ratio("dividends", "close") * F.lit(100.0), 2)
    )


def dividend_yield(tables: Tables, sector=None, as_of=None) -> DataFrame:
    """Fifteen highest trailing dividend yields."""
    members = stocks(tables, sector).select("security_id", "company_name")
    return (
        with_ticker(tables, _dividend_payers(tables, members, as_of))
        .orderBy(F.desc("div_yield_pct"), "security_id")
        .limit(TOP_YIELD)
        .select(
            "company_name",
            "ticker",
            "div_yield_pct",
            round_half_away("dividends", 3).alias("total_div_paid"),
            round_half_away("close", 2).alias("latest_close"),
        )
    )


def dividend_yield_detailed(tables: Tables, sector=None, as_of=None) -> DataFrame:
    """Twenty highest trailing dividend yields with industry and latest valuation."""
    members = stocks(tables, sector).select("security_id", "company_name", "industry_name")
    payers = _dividend_payers(tables, members, as_of)
    snaps = ts.latest_per_key(
        tables["Financial_Snapshot"], "security_id", "snapshot_date", ["pe_ratio", "market_cap"]
    )
    return (
        with_ticker(tables, payers.join(snaps, "security_id"))
        .orderBy(F.desc("div_yield_pct"), "security_id")
        .limit(TOP_YIELD_DETAILED)
        .select(
            "ticker",
            "company_name",
            "industry_name",
            F.col("div_yield_pct").alias("dividend_yield_pct"),
            F.col("pe_ratio").cast("double").alias("pe_ratio"),
            round_half_away(F.col("market_cap").cast("double") / F.lit(1e9), 2).alias("market_cap_billions"),
        )
    )


def cap_tiers(tables: Tables, sector=None) -> DataFrame:
    """Companies by market cap with one of four tier labels."""
    rows = _latest_snapshots(tables, stocks(tables, sector), ["market_cap"]).filter(F.col("market_cap").isNotNull())
    cap = F.col("market_cap")
    return (
        with_ticker(tables, rows)
        .orderBy(F.desc("market_cap"), "security_id")
        .select(
            "company_name",
            "ticker",
            "industry_name",
            round_half_away(cap.cast("double") / F.lit(1e9), 1).alias("mkt_cap_b"),
            _tier(cap, FOUR_TIERS, FOUR_TIERS_REST).alias("cap_tier"),
        )
    )


def cap_tier_distribution(tables: Tables, sector=None) -> DataFrame:
    """Companies and mean market cap per tier, five tiers."""
    rows = _latest_snapshots(tables, stocks(tables, sector), ["market_cap"]).filter(F.col("market_cap").isNotNull())
    cap = F.col("market_cap")
    # Caps are summed as decimals: billions of trillions do not fit a long.
    total = F.sum(cap.cast("decimal(20,0)"))
    return (
        rows.groupBy(_tier(cap, FIVE_TIERS, FIVE_TIERS_REST).alias("cap_tier"))
        .agg(
            F.count_distinct("company_id").alias("company_count"),
            round_half_away(_mean(total, F.count("*")) / F.lit(1e9), 2).alias("avg_mktcap_billions"),
            F.min(cap).alias("least"),
        )
        .orderBy(F.desc("least"))
        .drop("least")
    )


def _beta_by_industry(tables: Tables, sector, digits: int, count_name: str) -> DataFrame:
    rows = _latest_snapshots(tables, stocks(tables, sector), ["beta"]).filter(F.col("beta").isNotNull())
    return (
        rows.groupBy("industry_id", "industry_name")
        .agg(
            round_half_away(_mean(F.sum("beta"), F.count("beta")), digits).alias("avg_beta"),
            round_half_away(F.min("beta"), digits).alias("min_beta"),
            round_half_away(F.max("beta"), digits).alias("max_beta"),
            F.count_distinct("company_id").alias(count_name),
        )
        .orderBy(F.desc("avg_beta"), "industry_id")
        .drop("industry_id")
    )


def beta_dispersion(tables: Tables, sector=None) -> DataFrame:
    """Mean, least and largest beta per industry, three digits."""
    return _beta_by_industry(tables, sector, 3, "companies")


def beta_dispersion_fine(tables: Tables, sector=None) -> DataFrame:
    """The same with four digits."""
    return _beta_by_industry(tables, sector, 4, "company_count")


def _volume_totals(tables: Tables, start, end) -> DataFrame:
    return (
        dated(tables["Price"], "trade_date", start, end)
        .groupBy("security_id")
        .agg(
            F.sum("volume").alias("volume"),
            F.count("volume").alias("volume_days"),
            F.sum("close").alias("closes"),
            F.count("close").alias("close_days"),
        )
    )


def volume_leaders(tables: Tables, sector=None, start=DEFAULT_START, end=None) -> DataFrame:
    """Ten highest mean daily volumes with mean close, per ticker and company."""
    members = stocks(tables, sector).select("security_id", "company_name", "industry_name")
    totals = _volume_totals(tables, start, end).join(with_ticker(tables, members), "security_id")
    return (
        totals.groupBy("ticker", "company_name", "industry_name")
        .agg(
            round_half_away(_mean(F.sum("volume"), F.sum("volume_days")), 0).alias("avg_daily_vol"),
            round_half_away(_mean(F.sum("closes"), F.sum("close_days")), 2).alias("avg_close"),
        )
        .orderBy(F.desc("avg_daily_vol"), "ticker", "company_name")
        .limit(TOP_VOLUME)
    )


def volume_leaders_by_security(tables: Tables, sector=None, start=DEFAULT_START, end=None) -> DataFrame:
    """Ten highest mean daily volumes per security."""
    members = stocks(tables, sector).select("security_id", "company_name", "industry_name")
    leaders = (
        _volume_totals(tables, start, end)
        .select("security_id", round_half_away(_mean("volume", "volume_days"), 0).alias("avg_daily_volume"))
        .join(members, "security_id")
        .orderBy(F.desc("avg_daily_volume"), "security_id")
        .limit(TOP_VOLUME)
    )
    return (
        with_ticker(tables, leaders)
        .orderBy(F.desc("avg_daily_volume"), "security_id")
        .select("ticker", "company_name", "industry_name", "avg_daily_volume")
    )
