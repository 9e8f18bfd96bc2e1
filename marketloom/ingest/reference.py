"""Reference tables derived from the list of index members."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.ingest import fixed_values as fixed
from marketloom.operators.keys import assign_ids, next_id
from marketloom.schema import DEFAULT_COUNTRY, DEFAULT_CURRENCY
from marketloom.sources.files import CONSTITUENT_COLUMNS


def clean_constituents(raw: DataFrame, ordinal: str = "ordinal", max_symbols: int | None = None) -> DataFrame:
    """Complete members, one per normalised symbol: the first in input order.

    ``row_number() = 1`` is pre-limited before the shuffle, so copies of one
    symbol do not travel to one task. ``max_symbols`` keeps the first symbols in
    sorted order.
    """
    first = Window.partitionBy("symbol").orderBy(ordinal)
    rows = (
        raw.dropna(subset=list(CONSTITUENT_COLUMNS))
        .withColumn("symbol", F.replace(F.trim("symbol"), F.lit("."), F.lit("-")))
        .withColumn("__n", F.row_number().over(first))
        .filter(F.col("__n") == 1)
        .select(*CONSTITUENT_COLUMNS)
    )
    return rows if max_symbols is None else first_symbols(rows, max_symbols)


def first_symbols(constituents: DataFrame, n: int) -> DataFrame:
    """The first ``n`` members by symbol."""
    return constituents.orderBy("symbol").limit(n)


def sector_table(constituents: DataFrame) -> DataFrame:
    """Distinct sectors, numbered from 1 by name."""
    names = constituents.select(F.col("sector").alias("sector_name")).distinct()
    return assign_ids(names, ["sector_name"], "sector_id")


def industry_table(constituents: DataFrame, sectors: DataFrame) -> DataFrame:
    """Distinct (industry, sector) pairs, numbered by industry name."""
    pairs = constituents.select("sub_industry", "sector").distinct()
    numbered = assign_ids(pairs, ["sub_industry", "sector"], "industry_id")
    return numbered.join(sectors, F.col("sector") == F.col("sector_name")).select(
        "industry_id", F.col("sub_industry").alias("industry_name"), "sector_id"
    )


@dataclass(frozen=True)
class Listing:
    company: DataFrame
    security: DataFrame
    stock: DataFrame


def exchange_table(spark: SparkSession) -> DataFrame:
    """The fixed exchanges, as values in the plan: rows made in Python would start a worker on every core."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, fixed.EXCHANGES))} AS t(exchange_id, exchange_name, country, timezone)")


def exchange_of(symbol) -> Column:
    return (
        F.when(F.col(symbol).isin(*fixed.SECOND_EXCHANGE_SYMBOLS), fixed.SECOND_EXCHANGE)
        .otherwise(fixed.FIRST_EXCHANGE)
        .cast("long")
    )


def listing_tables(
    constituents: DataFrame, industries: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> Listing:
    """Company, security and stock of each member under one id, in symbol order.

    An industry name that occurs under two sectors resolves to its highest id.
    ``keep`` may store the numbered members, which all three start from.
    """
    numbered = keep(assign_ids(constituents, ["symbol"], "id"))
    last_id = industries.groupBy(F.col("industry_name").alias("sub_industry")).agg(
        F.max("industry_id").alias("industry_id")
    )
    company = numbered.join(last_id, "sub_industry").select(
        F.col("id").alias("company_id"),
        F.col("security").alias("company_name"),
        "industry_id",
        F.lit(DEFAULT_COUNTRY).alias("country"),
    )
    security = numbered.select(
        F.col("id").alias("security_id"),
        F.col("symbol").alias("ticker"),
        exchange_of("symbol").alias("exchange_id"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.lit("stock").alias("security_type"),
    )
    stock = numbered.select(F.col("id").alias("security_id"), F.col("id").alias("company_id"))
    return Listing(company, security, stock)


def added_securities(securities: DataFrame, added: DataFrame, kind: str, exchange: int) -> DataFrame:
    """(position, ticker) rows as securities with their position; ids continue after the largest one."""
    last = next_id(securities, "security_id")
    return added.select(
        (last + F.col("position")).cast("long").alias("security_id"),
        "ticker",
        F.lit(exchange).cast("long").alias("exchange_id"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.lit(kind).alias("security_type"),
        "position",
    )


def append_securities(securities: DataFrame, added: DataFrame, kind: str, exchange: int) -> DataFrame:
    """Appends (position, ticker) rows as securities."""
    return securities.unionByName(added_securities(securities, added, kind, exchange).drop("position"))


def ids_by_ticker(securities: DataFrame) -> DataFrame:
    """(ticker, security_id), the lowest id where several exchanges list a ticker."""
    return securities.groupBy("ticker").agg(F.min("security_id").alias("security_id"))


def append_funds(securities: DataFrame, symbols=None) -> DataFrame:
    """Appends the curated funds on the second exchange."""
    names = symbols if symbols is not None else [f[0] for f in fixed.FUNDS]
    rows = securities.sparkSession.createDataFrame(list(enumerate(names)), "position long, ticker string")
    return append_securities(securities, rows, "etf", fixed.SECOND_EXCHANGE)


def option_symbol(root, expiration, option_type, strike) -> Column:
    """Root, expiry as yyyymmdd, C or P, strike in thousandths on eight digits; cut to 20 characters."""
    thousandths = (F.col(strike) * 1000).cast("long").cast("string")
    text = F.concat(
        F.col(root),
        F.date_format(expiration, "yyyyMMdd"),
        F.when(F.col(option_type) == "call", "C").otherwise("P"),
        F.lpad(thousandths, F.greatest(F.lit(8), F.length(thousandths)), F.lit("0")),
    )
    return F.substring(text, 1, fixed.TICKER_CHARS)


def resolve_holdings(holdings: DataFrame, securities: DataFrame) -> DataFrame:
    """Holdings named by ticker under their security id; unknown tickers are dropped."""
    return holdings.join(ids_by_ticker(securities), "ticker").select(
        "portfolio_id", "security_id", "shares", "average_cost"
    )
