"""The derived relations themselves, so that every later comparison rests on checked inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.suite.registry import case

_PLAIN = {
    "Sector": "sector_id sector_name",
    "Industry": "industry_id industry_name sector_id",
    "Company": "company_id company_name industry_id country",
    "Exchange": "exchange_id exchange_name country timezone",
    "Security": "security_id ticker exchange_id currency security_type",
    "Stock": "security_id company_id",
    "ETF": "security_id fund_name expense_ratio",
    "Option_Contract": "option_id security_id expiration_date strike_price option_type implied_volatility open_interest",
    "Portfolio": "portfolio_id portfolio_name owner_name",
    "Holding": "portfolio_id security_id shares average_cost",
    "Price": "security_id trade_date open high low close volume",
    "Financial_Snapshot": "snapshot_id security_id snapshot_date market_cap pe_ratio eps beta",
    "Corporate_Action": "action_id security_id action_date action_type amount",
}
_WIDE = {"volume", "market_cap"} | {c for cols in _PLAIN.values() for c in cols.split() if c.endswith("_id")}
_DECIMAL = {"expense_ratio", "strike_price", "implied_volatility", "shares", "average_cost", "open", "high", "low",
            "close", "pe_ratio", "eps", "beta", "amount"}


def _sql(name):
    def shown(c):
        if c in _WIDE:
            return f"CAST({c} AS BIGINT) AS {c}"
        if c in _DECIMAL:
            return f"CAST({c} AS DOUBLE) AS {c}"
        return c

    return f"SELECT {', '.join(map(shown, _PLAIN[name].split()))} FROM {name}"


def _register(name):
    @case(f"table_{name.lower()}", sql=_sql(name), with_ids=True)
    def _(tables):
        return tables[name].select(*[
            F.col(c).cast("double") if c in _DECIMAL else F.col(c) for c in _PLAIN[name].split()
        ])


for _name in _PLAIN:
    if _name not in ("Exchange", "ETF"):
        _register(_name)


# The constant relations are shown with what the given tables hold for them.
@case("table_exchange", sql=f"""
    SELECT e.*, CAST(COALESCE(n, 0) AS BIGINT) AS n_securities FROM ({_sql('Exchange')}) AS e
    LEFT JOIN (SELECT exchange_id, COUNT(*) AS n FROM Security GROUP BY exchange_id) AS s ON s.exchange_id = e.exchange_id""")
def _(tables):
    listed = tables["Security"].groupBy("exchange_id").agg(F.count("*").alias("n"))
    columns = [F.col(c) for c in _PLAIN["Exchange"].split()]
    return tables["Exchange"].join(listed, "exchange_id", "left").select(
        *columns, F.coalesce("n", F.lit(0)).cast("long").alias("n_securities")
    )


@case("table_etf", sql=f"""
    SELECT f.*, ticker, CAST(COALESCE(n, 0) AS BIGINT) AS n_prices FROM ({_sql('ETF')}) AS f
    JOIN Security ON Security.security_id = f.security_id
    LEFT JOIN (SELECT security_id, COUNT(*) AS n FROM Price GROUP BY security_id) AS p ON p.security_id = f.security_id""")
def _(tables):
    priced = tables["Price"].groupBy("security_id").agg(F.count("*").alias("n"))
    rows = tables["ETF"].join(tables["Security"].select("security_id", "ticker"), "security_id").join(priced, "security_id", "left")
    return rows.select(
        "security_id", "fund_name", F.col("expense_ratio").cast("double").alias("expense_ratio"), "ticker",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_prices"),
    )
