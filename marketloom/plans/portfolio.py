"""Portfolio operations, each over any number of portfolios or requests at once.

Holdings travel as (portfolio_id, ticker, shares, cost, position), whether they
come from saved portfolios or from specs such as ``AAPL:10:150,MSFT:5:300``.
"""

from __future__ import annotations

from collections import ChainMap
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import leading_number, ratio, round_half_away, same_text
from marketloom.operators import timeseries as ts
from marketloom.operators.keys import assign_ids, join_dealt, next_id, range_of, rows_of
from marketloom.operators.valued import daily_sums
from marketloom.plans.common import DEFAULT_START, Tables, dated, ticker_key, trailing_dividends

# Owner marker, defaults and messages of the portfolio operations.
USER_PREFIX = "u:"
DEFAULT_NAME = "My Portfolio"
ETF_NAME = "ETF"
ETF_SECTOR = "ETF / Fund"
OTHER_SECTOR = "Other"
UNKNOWN_SECTOR = "Unknown ticker"
INVALID_OWNER = "invalid owner"
NO_HOLDINGS = "no valid holdings"
NOT_OWNED = "not your portfolio"
BAD_REQUEST = "bad request"
_BLANKS = " \t\n\r\0\x0b"


def _trimmed(column):
    return F.trim(F.col(column) if isinstance(column, str) else column, F.lit(_BLANKS))


def _is_user(owner):
    """User portfolios are marked by their owner; stored names compare without case."""
    return F.lower(owner).startswith(USER_PREFIX)


def list_portfolios(tables: Tables, owner: str = "") -> DataFrame:
    """Sample portfolios and the owner's own, with the number of holdings."""
    counts = tables["Holding"].groupBy("portfolio_id").agg(F.count("security_id").alias("holdings"))
    visible = tables["Portfolio"].filter(
        ~_is_user(F.col("owner_name")) | same_text("owner_name", F.lit(owner.strip(_BLANKS)))
    )
    return (
        visible.join(counts, "portfolio_id", "left")
        .select(
            "portfolio_id",
            "portfolio_name",
            "owner_name",
            (~_is_user(F.col("owner_name"))).cast("int").alias("is_sample"),
            F.coalesce("holdings", F.lit(0)).cast("long").alias("holdings"),
        )
        .orderBy(F.desc("is_sample"), "portfolio_id")
    )


def parse_specs(specs: DataFrame, key: str = "spec_id", spec: str = "spec") -> DataFrame:
    """Entries of spec texts as (key, ticker, shares, cost, position).

    Entries lacking a field, a ticker or a positive share count are skipped; the
    last entry of a ticker counts, at the position of its first.
    """
    fields = F.split("part", ":", -1)
    # Dealt by key first: texts are shuffled, not their entries, and a task aggregates its share of a large file.
    entries = (
        specs.select(key, spec).repartition(key).select(key, F.posexplode(F.split(spec, ",", -1)).alias("position", "part"))
        .filter(F.size(fields) >= 2)
        .select(
            key,
            "position",
            F.upper(_trimmed(F.get(fields, 0))).alias("ticker"),
            leading_number(F.get(fields, 1)).alias("shares"),
            leading_number(F.get(fields, 2)).alias("cost"),
        )
        .filter((F.col("ticker") != "") & (F.col("shares") > 0))
    )
    return entries.groupBy(key, "ticker").agg(
        F.max_by("shares", "position").alias("shares"),
        F.max_by("cost", "position").alias("cost"),
        F.min("position").cast("long").alias("position"),
    )


def saved_holdings(tables: Tables, portfolio_id: int | None = None, owner: str | None = None) -> DataFrame:
    """Holdings of one saved portfolio, or of all. ``owner`` restricts them to visible ones.

    Where two of its securities share a ticker, the later one counts.
    """
    rows = tables["Holding"]
    if portfolio_id is not None:
        rows = rows.filter(F.col("portfolio_id") == portfolio_id)
    if owner is not None:
        visible = tables["Portfolio"].filter(
            ~_is_user(F.col("owner_name")) | same_text("owner_name", F.lit(owner.strip(_BLANKS)))
        )
        rows = rows.join(visible.select("portfolio_id"), "portfolio_id", "left_semi")
    named = rows.join(tables["Security"].select("security_id", ticker_key(tables["Security"]).alias("ticker")), "security_id")
    return named.groupBy("portfolio_id", "ticker").agg(
        F.max_by(F.col("shares").cast("double"), "security_id").alias("shares"),
        F.max_by(F.col("average_cost").cast("double"), "security_id").alias("cost"),
        F.min("security_id").alias("position"),
    )


def resolve_holdings(tables: Tables, portfolio_id: int = 0, specs: DataFrame | None = None) -> DataFrame:
    """A saved portfolio when an id is given, else the parsed specs."""
    if portfolio_id > 0 or specs is None:
        return saved_holdings(tables, portfolio_id)
    return parse_specs(specs).withColumnRenamed("spec_id", "portfolio_id")


def _ticker_ids(tables: Tables, tickers: DataFrame | None) -> DataFrame:
    """(ticker, security_id, security_type), of the lowest id where several exchanges list a ticker."""
    listed = tables["Security"].select(ticker_key(tables["Security"]).alias("ticker"), "security_id", "security_type")
    if tickers is not None:
        listed = listed.join(tickers.select("ticker"), "ticker", "left_semi")
    lowest = listed.groupBy("ticker").agg(F.min(F.struct("security_id", "security_type")).alias("lowest"))
    return lowest.select("ticker", "lowest.*")


def reference(tables: Tables, tickers: DataFrame | None = None, as_of=None, few: bool = False) -> DataFrame:
    """Per ticker: security, company, sector, latest close and a year of dividends per share.

    ``few`` says that the tickers are those of a portfolio or two: the facts are
    cut down to their ids before anything else. The result is the same without.
    """
    ids = _ticker_ids(tables, tickers)
    if few:
        tables = ChainMap({name: rows_of(tables[name], ids) for name in ("Price", "Corporate_Action")}, tables)
    classified = (
        tables["Stock"]
        .join(tables["Company"].select("company_id", "company_name", "industry_id"), "company_id", "left")
        .join(tables["Industry"].select("industry_id", "sector_id"), "industry_id", "left")
        .join(tables["Sector"].select("sector_id", "sector_name"), "sector_id", "left")
        .select("security_id", "company_name", "sector_name")
    )
    closes = ts.latest_per_key(tables["Price"], "security_id", "trade_date", ["close"])
    return (
        ids.join(classified, "security_id", "left")
        .join(closes.select("security_id", F.col("close").alias("latest_close")), "security_id", "left")
        .join(trailing_dividends(tables, as_of), "security_id", "left")
        .select(
            "ticker",
            "security_id",
            "security_type",
            "company_name",
            "sector_name",
            F.col("latest_close").cast("double").alias("latest_close"),
            F.coalesce(F.col("dividends").cast("double"), F.lit(0.0)).alias("div12"),
        )
    )


def value_holdings(tables: Tables, holdings: DataFrame, as_of=None, few: bool = False) -> DataFrame:
    """Market value, gain and dividend income per holding; gaps where there is no price."""
    ref = reference(tables, holdings.select("ticker").distinct(), as_of, few)
    known = F.col("security_id").isNotNull()
    fund = F.col("security_type") == "etf"
    joined = holdings.join(ref, "ticker", "left") if few else join_dealt(holdings, ref, "ticker", "portfolio_id", "left")
    rows = (
        joined
        .withColumn("mv", F.col("latest_close") * F.col("shares"))
        .withColumn("cb", F.col("cost") * F.col("shares"))
        .withColumn("pl", F.col("mv") - F.col("cb"))
    )
    return rows.select(
        "portfolio_id",
        "ticker",
        F.coalesce("company_name", F.when(fund, ETF_NAME)).alias("company_name"),
        F.when(known, F.coalesce("sector_name", F.when(fund, ETF_SECTOR), F.lit(OTHER_SECTOR)))
        .otherwise(UNKNOWN_SECTOR)
        .alias("sector_name"),
        round_half_away("shares", 4).alias("shares"),
        round_half_away("cost", 4).alias("avg_cost"),
        round_half_away("latest_close", 2).alias("latest_close"),
        round_half_away("mv", 2).alias("market_value"),
        round_half_away("cb", 2).alias("cost_basis"),
        round_half_away("pl", 2).alias("unrealized_pl"),
        F.when(F.col("cb") > 0, round_half_away(ratio("pl", "cb") * F.lit(100.0), 2)).alias("unrealized_pl_pct"),
        F.coalesce(round_half_away(F.col("div12") * F.col("shares"), 2), F.lit(0.0)).alias("div_income_12mo"),
    )


#: Positions of the portfolios that one task values, about.
SLOT_POSITIONS = 2_000_000


def value_series(tables: Tables, holdings: DataFrame, start=DEFAULT_START, end=None, few: bool = False) -> DataFrame:
    """Value per portfolio and trading day; a holding without a price that day adds nothing."""
    ids = _ticker_ids(tables, holdings.select("ticker").distinct())
    joined = holdings.join(ids, "ticker") if few else join_dealt(holdings, ids, "ticker", "portfolio_id")
    positions = joined.select("portfolio_id", "security_id", "shares")
    prices = dated(tables["Price"], "trade_date", start, end).select("security_id", "trade_date", "close")
    if few:
        worth = F.col("close").cast("double") * F.col("shares")
        valued = (
            range_of(prices, ids).join(positions, "security_id")
            .groupBy("portfolio_id", "trade_date").agg(F.sum(worth).alias("port_value"))
        )
    else:
        held = prices.join(ids.select("security_id"), "security_id", "left_semi")
        valued = daily_sums(positions, held, "portfolio_id", "security_id", "trade_date", "shares", "close",
                            "port_value", SLOT_POSITIONS)
    return valued.withColumn("port_value", round_half_away("port_value", 2))


def inline_holdings(spark, holdings: list[tuple[str, float, float]], portfolio_id: int = 0) -> DataFrame:
    """Holdings given as Python values, as a relation other operators can join."""
    schema = "ticker string, shares double, cost double, position long"
    rows = [(t.strip().upper(), float(s), float(c), i) for i, (t, s, c) in enumerate(holdings)]
    return spark.createDataFrame(rows, schema).select(F.lit(portfolio_id).cast("long").alias("portfolio_id"), "*")


# -- saving and deleting --------------------------------------------------------


@dataclass(frozen=True)
class Saved:
    portfolio: DataFrame
    holding: DataFrame
    report: DataFrame


def _checked(tables: Tables, requests: DataFrame, entries: DataFrame) -> DataFrame:
    """Requests with a cleaned owner and name and the first failed test, if any."""
    owner = F.coalesce(_trimmed("owner"), F.lit(""))
    name = F.coalesce(_trimmed("name"), F.lit(""))
    asked = requests.select(
        "request_id",
        owner.alias("owner"),
        F.when(name == "", DEFAULT_NAME).otherwise(name).alias("name"),
        F.coalesce("portfolio_id", F.lit(0)).cast("long").alias("asked_id"),
    )
    usable = entries.select("request_id").distinct().withColumn("usable", F.lit(True))
    owned = tables["Portfolio"].select(F.col("portfolio_id").alias("asked_id"), F.col("owner_name"))
    error = (
        F.when(~F.col("owner").startswith(USER_PREFIX), INVALID_OWNER)
        .when(F.col("usable").isNull(), NO_HOLDINGS)
        .when((F.col("asked_id") > 0) & ~F.col("owner").eqNullSafe(F.col("owner_name")), NOT_OWNED)
    )
    return (
        asked.join(usable, "request_id", "left")
        .join(owned, "asked_id", "left")
        .select("request_id", "owner", "name", "asked_id", error.alias("error"))
    )


def _entries(requests: DataFrame) -> DataFrame:
    return parse_specs(requests, key="request_id", spec="holdings")


def save_errors(tables: Tables, requests: DataFrame) -> DataFrame:
    """Rejected requests with the reason."""
    checked = _checked(tables, requests, _entries(requests))
    return checked.filter(F.col("error").isNotNull()).select("request_id", "error")


def save_portfolios(tables: Tables, requests: DataFrame) -> Saved:
    """Applies a batch of save requests and returns both tables and a report.

    Requests see the tables as they were before the batch. Of several updates to
    one portfolio the last request stays; every accepted request is reported.
    """
    entries = _entries(requests)
    accepted = _checked(tables, requests, entries).filter(F.col("error").isNull())

    created = assign_ids(
        accepted.filter(F.col("asked_id") <= 0).select("request_id", "owner", "name"),
        ["request_id"],
        "portfolio_id",
        start=next_id(tables["Portfolio"], "portfolio_id"),
    )
    updates = accepted.filter(F.col("asked_id") > 0).select(
        F.col("asked_id").alias("portfolio_id"), "request_id", "owner", "name"
    )
    last = updates.groupBy("portfolio_id").agg(F.max("request_id").alias("request_id"))
    winners = updates.join(last.select("request_id"), "request_id", "left_semi")
    targets = created.select("portfolio_id", "request_id").unionByName(updates.select("portfolio_id", "request_id"))

    ids = _ticker_ids(tables, entries.select("ticker").distinct())
    stored = join_dealt(entries, ids, "ticker", "request_id").select(
        "request_id",
        "security_id",
        F.round("shares", 4).try_cast("decimal(14,4)").alias("shares"),
        F.round(F.greatest("cost", F.lit(0.0)), 4).try_cast("decimal(12,4)").alias("average_cost"),
    )
    stored = stored.filter((F.col("shares") > 0) & F.col("average_cost").isNotNull())

    counted = stored.groupBy("request_id").agg(F.count("*").alias("saved"))
    report = targets.join(counted, "request_id", "left").select(
        "request_id", "portfolio_id", F.coalesce("saved", F.lit(0)).cast("long").alias("saved")
    )

    kept = created.select("portfolio_id", "request_id").unionByName(winners.select("portfolio_id", "request_id"))
    fresh = stored.join(kept, "request_id").select("portfolio_id", "security_id", "shares", "average_cost")
    holding = (
        tables["Holding"]
        .join(winners.select("portfolio_id"), "portfolio_id", "left_anti")
        .select("portfolio_id", "security_id", "shares", "average_cost")
        .unionByName(fresh)
    )
    renamed = (
        tables["Portfolio"]
        .join(winners.select("portfolio_id", "name"), "portfolio_id", "left")
        .select("portfolio_id", F.coalesce("name", "portfolio_name").alias("portfolio_name"), "owner_name")
    )
    portfolio = renamed.unionByName(
        created.select("portfolio_id", F.col("name").alias("portfolio_name"), F.col("owner").alias("owner_name"))
    )
    return Saved(portfolio, holding, report)


def delete_portfolios(tables: Tables, requests: DataFrame) -> Saved:
    """Deletes owned portfolios with their holdings; the report counts them per request."""
    asked = requests.select(
        "request_id",
        F.coalesce(_trimmed("owner"), F.lit("")).alias("owner"),
        F.coalesce("portfolio_id", F.lit(0)).cast("long").alias("portfolio_id"),
    )
    valid = F.col("owner").startswith(USER_PREFIX) & (F.col("portfolio_id") > 0)
    hits = (
        asked.filter(valid)
        .join(tables["Portfolio"].select("portfolio_id", "owner_name"), "portfolio_id")
        .filter(same_text("owner_name", "owner"))
        .groupBy("portfolio_id")
        .agg(F.min("request_id").alias("request_id"))
    )
    done = hits.select("request_id").withColumn("hit", F.lit(True))
    report = asked.join(done, "request_id", "left").select(
        "request_id",
        F.when(valid, F.col("hit").isNotNull().cast("long")).alias("deleted"),
        F.when(~valid, BAD_REQUEST).alias("error"),
    )
    gone = hits.select("portfolio_id")
    return Saved(
        tables["Portfolio"].join(gone, "portfolio_id", "left_anti"),
        tables["Holding"].join(gone, "portfolio_id", "left_anti"),
        report,
    )
