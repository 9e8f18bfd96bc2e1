"""From landed raw data to the thirteen tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.ingest import fixed_values as fixed
from marketloom.ingest import market, reference
from marketloom.quality import constraints
from marketloom.schema import TABLES
from marketloom.session import side_by_side
from marketloom.sources import files, store
from marketloom.sources.files import conform

CONSTITUENTS = "constituents"
# Landed files besides the list of members: tab-separated, one folder each, with these columns.
LAYOUTS = {
    "prices": "symbol string, trade_date date, open double, high double, low double, close double, volume double",
    "fund_info": "symbol string, long_name string, short_name string, expense_a double, expense_b double",
    "chain": "underlying string, expiration_date date, option_type string, strike decimal(12,2), "
             "implied_volatility double, open_interest int",
    "info": "symbol string, market_cap long, trailing_pe double, trailing_eps double, beta double",
    "actions": "symbol string, action_date date, kind string, value double",
}


@dataclass(frozen=True)
class Curated:
    """What is chosen rather than delivered: funds, contracts to follow, and portfolios.

    ``funds``: position, symbol, name_fallback, expense_fallback. ``options``:
    position, underlying, expiration_date, strike, option_type, iv_fallback,
    oi_fallback. Positions count from 0 and give the order of the ids.
    ``holdings`` names securities by ticker.
    """

    funds: DataFrame
    options: DataFrame
    portfolios: DataFrame
    holdings: DataFrame

    @classmethod
    def standard(cls, spark: SparkSession) -> Curated:
        options = spark.createDataFrame(
            [(i, *o) for i, o in enumerate(fixed.OPTIONS)],
            "position long, underlying string, expiration string, strike double, option_type string, "
            "iv_fallback double, oi_fallback int",
        )
        return cls(
            funds=spark.createDataFrame(
                [(i, *f) for i, f in enumerate(fixed.FUNDS)],
                "position long, symbol string, name_fallback string, expense_fallback double",
            ),
            options=options.withColumn("expiration_date", F.to_date("expiration")).withColumn(
                "strike", F.col("strike").cast("decimal(12,2)")
            ),
            portfolios=spark.createDataFrame(
                list(fixed.PORTFOLIOS), "portfolio_id long, portfolio_name string, owner_name string"
            ),
            holdings=spark.createDataFrame(
                [(p, t, float(s), c) for p, t, s, c in fixed.HOLDINGS],
                "portfolio_id long, ticker string, shares double, average_cost double",
            ),
        )


def land(raw: Mapping[str, DataFrame], root: str) -> None:
    """Writes raw data as the files that ``landed`` reads; members in the order of their ``ordinal``."""
    writes = [partial(files.write_constituents, raw[CONSTITUENTS].orderBy("ordinal"), f"{root}/{CONSTITUENTS}")]
    for name, layout in LAYOUTS.items():
        columns = [f"CAST({c.name} AS {c.dataType.simpleString()}) AS {c.name}" for c in T.StructType.fromDDL(layout)]
        writes.append(partial(files.write_tsv, raw[name].selectExpr(*columns), f"{root}/{name}"))
    side_by_side(raw[CONSTITUENTS].sparkSession, writes)


def landed(spark: SparkSession, root: str, fallback: DataFrame | None = None) -> dict[str, DataFrame]:
    """The landed files as typed rows; ``fallback`` stands in for an empty list of members."""
    members = files.read_constituents(spark, f"{root}/{CONSTITUENTS}")
    raw = {CONSTITUENTS: members if fallback is None else files.first_available(members, fallback)}
    for name, layout in LAYOUTS.items():
        raw[name] = files.read_tsv(spark, f"{root}/{name}", T.StructType.fromDDL(layout))
    return raw


def load(spark: SparkSession, landing: str, root: str, curated: Curated | None = None, **params) -> int:
    """Landed files to a new version of the store: read, cleaned, numbered, checked against every rule, committed."""
    built = build_tables(landed(spark, landing), curated, keep=store.stage(spark, root), **params)
    return store.full_refresh(spark, built, root, check=constraints.EACH_TABLE)


def refresh(spark: SparkSession, landing: str, root: str, today, curated: Curated | None = None, **params) -> list[int] | int:
    """The run of a day: everything on a Sunday or into an empty store, only the prices of the landed days else.

    A daily run takes the ids of the current load, and rewrites the years it has
    prices of; it returns these years, a full run its version.
    """
    mode = spark.range(1).select(market.run_mode(F.lit(today).cast("date"))).first()[0]
    if mode == market.FULL or not store.current_version(spark, root):
        return load(spark, landing, root, curated, mode=mode, today=today, **params)
    tables = store.open_store(spark, root)
    first, last = market.date_range(params.get("start"), params.get("end"), today)
    days = landed(spark, landing)["prices"].filter(F.col("trade_date").between(first, last))
    return store.load_days(spark, root, market.clean_prices(days, tables["Security"]))


def build_tables(
    raw: Mapping[str, DataFrame], curated: Curated | None = None, *, mode: str = market.DAILY, start=None, end=None,
    today=None, max_symbols: int | None = None, keep: Callable[[DataFrame, str], DataFrame] = lambda rows, name: rows,
) -> dict[str, DataFrame]:
    """Builds every table from ``constituents``, ``prices``, ``fund_info``, ``chain``, ``info`` and ``actions``.

    Sizes that follow the market are joins and aggregations; the curated lists
    are small, and constants unless given. Nearly every table starts from the
    numbered ones before it, and an id reads its rows three times: ``keep``
    may store such a step under a name and return what was stored. Without it
    each table is one plan from the raw rows, with all steps before it in it,
    several times over.
    """
    spark = raw["constituents"].sparkSession
    first, last = market.date_range(start, end, today)
    curated = curated or Curated.standard(spark)
    members, chosen_funds, contracts = side_by_side(spark, [
        partial(keep, reference.clean_constituents(raw["constituents"], max_symbols=max_symbols), "members"),
        partial(keep, curated.funds, "funds"),
        partial(keep, curated.options, "options"),
    ])
    sectors = keep(reference.sector_table(members), "sectors")
    industries = keep(reference.industry_table(members, sectors), "industries")
    listing = reference.listing_tables(members, industries, lambda rows: keep(rows, "numbered"))
    funds = chosen_funds.select("position", F.col("symbol").alias("ticker"))
    with_funds = keep(
        reference.append_securities(listing.security, funds, "etf", fixed.SECOND_EXCHANGE), "with_funds"
    )

    targets = contracts.withColumn(
        "ticker", reference.option_symbol("underlying", "expiration_date", "option_type", "strike")
    )
    added = reference.added_securities(
        with_funds, targets.select("position", "ticker"), "option", fixed.OPTION_EXCHANGE
    )
    securities = with_funds.unionByName(added.drop("position"))
    # Tickers are cut to their length, so two contracts may share one: join on the position.
    option_ids = added.select("position", "security_id")
    underlying_ids = with_funds.select(F.col("ticker").alias("underlying"), F.col("security_id").alias("underlying_id"))
    chain = raw["chain"]
    if "underlying" in chain.columns:
        chain = chain.join(underlying_ids, "underlying")
    quoted = market.nearest_strikes(targets.join(underlying_ids, "underlying", "left"), chain)
    options = quoted.join(option_ids, "position").select(
        (F.col("position") + 1).alias("option_id"), "security_id", "expiration_date",
        F.col("strike").alias("strike_price"), "option_type", "implied_volatility", "open_interest",
    )

    fund_ids = with_funds.filter(F.col("security_type") == "etf").select(F.col("ticker").alias("symbol"), "security_id")
    etfs = market.fund_metadata(chosen_funds, raw["fund_info"]).join(fund_ids, "symbol")
    scope = market.fundamentals_scope(members, mode)
    days = raw["prices"].filter(F.col("trade_date").between(first, last))
    # Ids and the ranges of a stored table take passes of their own over the rows: lines are parsed in one before.
    snapshots, actions, prices = side_by_side(spark, [
        partial(keep, market.clean_snapshots(scope, raw["info"], listing.security, last), "snapshots"),
        partial(keep, raw["actions"].filter(F.col("action_date").between(first, last)), "actions"),
        partial(keep, market.clean_prices(days, with_funds), "prices"),
    ])
    built = {
        "Sector": sectors,
        "Industry": industries,
        "Company": listing.company,
        "Exchange": reference.exchange_table(spark),
        "Security": securities,
        "Stock": listing.stock,
        "ETF": etfs,
        "Option_Contract": options,
        "Portfolio": curated.portfolios,
        "Holding": reference.resolve_holdings(curated.holdings, with_funds),
        "Price": prices,
        "Financial_Snapshot": market.snapshot_table(snapshots),
        "Corporate_Action": market.classify_actions(actions, scope, listing.security, first, last),
    }
    return {name: conform(rows, TABLES[name]) for name, rows in built.items()}
