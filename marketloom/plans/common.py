"""Pieces shared by the analyses: parameters, ticker scope, dimensions, benchmark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import day, pct_change, same_text, year_before
from marketloom.operators.keys import rows_of
from marketloom.operators.timeseries import endpoints_in_range

Tables = Mapping[str, DataFrame]

# Parameter defaults of the analyses.
DEFAULT_TICKER = "AAPL"
DEFAULT_START = "2024-01-01"
DEFAULT_MIN_QUARTERS = 4
BENCHMARK = "SPY"
ALL_SECTORS = "ALL"


def between(column: str, start, end):
    return F.col(column).between(day(start), day(end))


def dated(rows: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows dated within the bounds given.

    Stores split by year carry the year as a column of its own; bounding it too
    lets whole folders be skipped.
    """
    year = f"{column}_year"
    split = year in rows.columns
    if start is not None:
        rows = rows.filter(F.col(column) >= day(start))
        rows = rows.filter(F.col(year) >= F.year(day(start))) if split else rows
    rows = rows.filter(F.col(column) <= day(end))
    return rows.filter(F.col(year) <= F.year(day(end))) if split else rows


def ticker_key(securities: DataFrame) -> Column:
    """The upper-case ticker. The store holds it as a column, which a comparison reaches in the file scan."""
    return F.col("ticker_key") if "ticker_key" in securities.columns else F.upper("ticker")


def listings(tables: Tables, ticker: str) -> DataFrame:
    """Securities listed under a ticker: one per exchange at most."""
    return tables["Security"].filter(ticker_key(tables["Security"]) == ticker.strip().upper())


def of_ticker(tables: Tables, name: str, ticker: str | None) -> DataFrame:
    """Rows of a security-keyed table for one ticker, or the whole table for None."""
    rows = tables[name]
    if ticker is None:
        return rows
    return rows_of(rows, listings(tables, ticker))


def labelled(tables: Tables, result: DataFrame, ticker: str | None, order: list, columns: list) -> DataFrame:
    """Final projection: sorted for one ticker; with a leading ticker column for all.

    The all-tickers form is left unsorted: it is a table to store, not a page to read.
    """
    if ticker is not None:
        return result.orderBy(*order).select(*columns)
    names = tables["Security"].select("security_id", "ticker")
    return result.join(names, "security_id").select("ticker", *columns)


def stocks(tables: Tables, sector: str | None = None) -> DataFrame:
    """Stocks with company, industry and sector, optionally of one sector.

    The classification levels join smallest first, so a sector filter thins the
    companies before they meet the stocks. No side is forced to be broadcast:
    Spark compares each with its broadcast threshold, at plan time and again at
    run time.
    """
    sectors = tables["Sector"].select("sector_id", "sector_name")
    if sector is not None:
        sectors = sectors.filter(same_text("sector_name", F.lit(sector)))
    industries = tables["Industry"].select("industry_id", "industry_name", "sector_id").join(sectors, "sector_id")
    companies = tables["Company"].select("company_id", "company_name", "industry_id").join(industries, "industry_id")
    return tables["Stock"].select("security_id", "company_id").join(companies, "company_id")


def with_ticker(tables: Tables, rows: DataFrame) -> DataFrame:
    return rows.join(tables["Security"].select("security_id", "ticker"), "security_id")


def with_benchmark(tables: Tables, rows: DataFrame, start, end, benchmark: str = BENCHMARK) -> DataFrame:
    """Adds ``bench_return``: one row per distinct benchmark leg, none without a benchmark.

    The legs (one per listing of the benchmark ticker) reach the rows as a
    scalar subquery, so nothing is cross-joined.
    """
    prices = of_ticker(tables, "Price", benchmark)
    legs = (
        endpoints_in_range(prices, start, end)
        .agg(F.collect_set(F.struct("first_close", "last_close")).alias("legs"))
        .scalar()
    )
    return (
        rows.select("*", F.explode(legs).alias("leg"))
        .withColumn("bench_return", pct_change(F.col("leg.last_close"), F.col("leg.first_close")))
        .drop("leg")
    )


def stock_returns(prices: DataFrame, start, end) -> DataFrame:
    ends = endpoints_in_range(prices, start, end)
    return ends.select("security_id", pct_change("last_close", "first_close").alias("total_return"))


def trailing_dividends(tables: Tables, as_of) -> DataFrame:
    """Dividends per security since one year before ``as_of``; no upper bound."""
    paid = (F.col("action_type") == "dividend") & (F.col("action_date") >= year_before(as_of))
    return tables["Corporate_Action"].filter(paid).groupBy("security_id").agg(F.sum("amount").alias("dividends"))
