"""Analyses by name, with the shared parameters and their defaults."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.plans import portfolio, sector, security
from marketloom.plans.common import ALL_SECTORS, DEFAULT_MIN_QUARTERS, DEFAULT_START, DEFAULT_TICKER, Tables


def _spec(tables: Tables, holdings: str) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(F.lit(0).cast("long").alias("spec_id"), F.lit(holdings).alias("spec"))


def portfolio_holdings(tables: Tables, pid=0, holdings="", as_of=None) -> DataFrame:
    """Valued holdings of a saved portfolio or of a spec, in the order they were given."""
    held = portfolio.resolve_holdings(tables, pid, _spec(tables, holdings))
    valued = portfolio.value_holdings(tables, held, as_of, few=True)
    return valued.join(held.select("ticker", "position"), "ticker").orderBy("position").drop("position", "portfolio_id")


def portfolio_series(tables: Tables, pid=0, holdings="", start=DEFAULT_START, end=None) -> DataFrame:
    """Daily value of a saved portfolio or of a spec."""
    held = portfolio.resolve_holdings(tables, pid, _spec(tables, holdings))
    return portfolio.value_series(tables, held, start, end, few=True).orderBy("trade_date").drop("portfolio_id")


def _request(tables: Tables, owner: str, name: str, holdings: str, pid: int) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(
        F.lit(0).cast("long").alias("request_id"), F.lit(owner).alias("owner"), F.lit(name).alias("name"),
        F.lit(holdings).alias("holdings"), F.lit(pid).cast("long").alias("portfolio_id"),
    )


def save_portfolio(tables: Tables, owner="", portfolio_name="", holdings="", pid=0) -> DataFrame:
    """What saving would do: the portfolio and its holdings, or the reason why not.

    ``portfolio.save_portfolios`` gives the tables to commit.
    """
    request = _request(tables, owner, portfolio_name, holdings, pid)
    done = portfolio.save_portfolios(tables, request).report.withColumn("error", F.lit(None).cast("string"))
    return done.unionByName(portfolio.save_errors(tables, request), allowMissingColumns=True).drop("request_id")


def delete_portfolio(tables: Tables, owner="", pid=0) -> DataFrame:
    """What deleting would do; ``portfolio.delete_portfolios`` gives the tables to commit."""
    return portfolio.delete_portfolios(tables, _request(tables, owner, "", "", pid)).report.drop("request_id")


ANALYSES: dict[str, Callable[..., DataFrame]] = {
    "sectors": sector.sectors,
    "tickers": sector.tickers,
    "s1": security.close_series,
    "s2": security.rolling_volatility,
    "s3": security.iv_term_structure,
    "s4": security.action_impact,
    "s5": security.return_vs_benchmark,
    "s6": security.snapshot_trend,
    "r1": sector.sector_vs_benchmark,
    "r2": sector.pe_by_industry,
    "r3": sector.eps_growth_count,
    "r4": sector.top_volatile,
    "r5": sector.below_average_pe,
    "r6": sector.dividend_yield,
    "r7": sector.cap_tiers,
    "r8": sector.beta_dispersion,
    "r9": sector.volume_leaders,
    "q01": security.daily_return,
    "q02": security.rolling_volatility_calendar,
    "q03": security.iv_active,
    "q04": security.action_impact_span,
    "q05": security.return_vs_benchmark_named,
    "q06": security.snapshot_measures,
    "q07": sector.sector_vs_benchmark_counted,
    "q08": sector.pe_by_industry_min_cap,
    "q09": sector.eps_growth_strict,
    "q10": sector.top_price_stddev,
    "q11": sector.below_average_pe_distinct,
    "q12": sector.dividend_yield_detailed,
    "q13": sector.cap_tier_distribution,
    "q14": sector.beta_dispersion_fine,
    "q15": sector.volume_leaders_by_security,
    "portfolios": portfolio.list_portfolios,
    "pf_holdings": portfolio_holdings,
    "pf_series": portfolio_series,
    "pf_save": save_portfolio,
    "pf_delete": delete_portfolio,
}


def run(name: str, tables: Tables, **given) -> DataFrame:
    """Runs an analysis. Parameters it does not take are ignored, absent ones get defaults.

    A sector is matched by name; leaving it out selects nothing, except where the
    analysis covers all sectors by default.
    """
    if name not in ANALYSES:
        raise ValueError(f"unknown query: {name}")
    analysis = ANALYSES[name]
    params = {
        "ticker": str(given.get("ticker", DEFAULT_TICKER)).strip().upper(),
        "sector": str(given.get("sector", "")).strip(),
        "start": given.get("start", DEFAULT_START),
        "end": given.get("end"),
        "as_of": given.get("as_of"),
        "min_cap": float(given.get("min_cap", 0)),
        "min_q": max(1, int(given.get("min_q", DEFAULT_MIN_QUARTERS))),
        "owner": str(given.get("owner", "")),
        "pid": int(given.get("pid", 0)),
        "holdings": given.get("holdings", ""),
        "portfolio_name": given.get("portfolio_name", ""),
    }
    if analysis is sector.eps_growth_count:
        params["sector"] = params["sector"] or ALL_SECTORS
    takes = inspect.signature(analysis).parameters
    return analysis(tables, **{k: v for k, v in params.items() if k in takes})
