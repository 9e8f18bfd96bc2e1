"""Registered ingest transforms over the raw relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.ingest import fixed_values as fixed
from marketloom.ingest import market, pipeline, reference
from marketloom.operators.keys import assign_ids
from marketloom.quality.constraints import key_text
from marketloom.schema import LOAD_ORDER, TABLES
from marketloom.session import scratch_path
from marketloom.sources import store
from marketloom.sources.derived import WIDE_SLOTS
from marketloom.sources.store import row_counts
from marketloom.suite.registry import END, START, case, line_sql

_MEMBERS = """members AS (
        SELECT symbol, security, sector, sub_industry FROM (
            SELECT REPLACE(TRIM(symbol), '.', '-') AS symbol, security, sector, sub_industry, ordinal FROM raw_constituents
            WHERE symbol IS NOT NULL AND security IS NOT NULL AND sector IS NOT NULL AND sub_industry IS NOT NULL) AS kept
        QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY ordinal) = 1)"""
_SECTORS = """sectors AS (
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY sector) AS BIGINT) AS sector_id, sector AS sector_name
        FROM (SELECT DISTINCT sector FROM members) AS names)"""
_INDUSTRIES = """industries AS (
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY sub_industry, sector) AS BIGINT) AS industry_id,
               sub_industry AS industry_name, sector_id
        FROM (SELECT DISTINCT sub_industry, sector FROM members) AS pairs JOIN sectors ON sector = sector_name)"""
_NUMBERED = "numbered AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY symbol) AS BIGINT) AS id, * FROM members)"
_CLEAN = f"WITH {_MEMBERS}"


def _members(tables):
    return reference.clean_constituents(tables["raw_constituents"])


@case("ing_constituents", sql=f"{_CLEAN} SELECT * FROM members")
def _(tables):
    return _members(tables)


@case("ing_row_cap", sql=f"{_CLEAN} SELECT * FROM members ORDER BY symbol LIMIT 40")
def _(tables):
    return reference.clean_constituents(tables["raw_constituents"], max_symbols=40)


@case("ing_dim_sector", sql=f"{_CLEAN}, {_SECTORS} SELECT * FROM sectors")
def _(tables):
    return reference.sector_table(_members(tables))


@case("ing_dim_industry", sql=f"{_CLEAN}, {_SECTORS}, {_INDUSTRIES} SELECT * FROM industries")
def _(tables):
    members = _members(tables)
    return reference.industry_table(members, reference.sector_table(members))


_LISTED = f"{_CLEAN}, {_SECTORS}, {_INDUSTRIES}, {_NUMBERED}"


def _listing(tables):
    members = _members(tables)
    return reference.listing_tables(members, reference.industry_table(members, reference.sector_table(members)))


@case("ing_dim_company", sql=f"""{_LISTED}
    SELECT id AS company_id, security AS company_name,
           (SELECT MAX(industry_id) FROM industries WHERE industry_name = sub_industry) AS industry_id, 'US' AS country
    FROM numbered""")
def _(tables):
    return _listing(tables).company


@case("ing_dim_stock", sql=f"{_LISTED} SELECT id AS security_id, id AS company_id FROM numbered")
def _(tables):
    return _listing(tables).stock


_NAMES = ", ".join(f"'{s}'" for s in fixed.SECOND_EXCHANGE_SYMBOLS)


@case("ing_exchange_assign", sql=f"""{_LISTED}
    SELECT id AS security_id, symbol AS ticker, CAST(CASE WHEN symbol IN ({_NAMES}) THEN 2 ELSE 1 END AS BIGINT) AS exchange_id,
           'USD' AS currency, 'stock' AS security_type
    FROM numbered""")
def _(tables):
    return _listing(tables).security


@case("ing_exchange_assign_known", sql=f"""
    SELECT security_id, symbol, CAST(CASE WHEN symbol IN ({_NAMES}) THEN 2 ELSE 1 END AS BIGINT) AS exchange_id
    FROM (SELECT security_id, CASE security_id % 3 WHEN 0 THEN 'AAPL' WHEN 1 THEN 'IDXX' ELSE ticker END AS symbol
          FROM Security) AS named""")
def _(tables):
    sid = F.col("security_id")
    symbol = F.when(sid % 3 == 0, "AAPL").when(sid % 3 == 1, "IDXX").otherwise(F.col("ticker"))
    named = tables["Security"].select("security_id", symbol.alias("symbol"))
    return named.withColumn("exchange_id", reference.exchange_of("symbol"))


_FUND_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{f[0]}' AS ticker" for i, f in enumerate(fixed.FUNDS)
)


@case("ing_etf_append", sql=f"""WITH funds AS ({_FUND_ROWS})
    SELECT security_id, ticker, CAST(exchange_id AS BIGINT) AS exchange_id, currency, security_type FROM Security
    UNION ALL SELECT (SELECT MAX(security_id) FROM Security) + 1 + position, ticker, 2, 'USD', 'etf' FROM funds""")
def _(tables):
    return reference.append_funds(tables["Security"])


@case("ing_option_symbol", sql="""
    SELECT option_id,
           SUBSTR('S' || CAST(underlying_id AS VARCHAR) || STRFTIME(expiration_date, '%Y%m%d')
                  || CASE option_type WHEN 'call' THEN 'C' ELSE 'P' END
                  || LPAD(CAST(CAST(strike_price * 1000 AS BIGINT) AS VARCHAR),
                          CAST(GREATEST(8, LENGTH(CAST(CAST(strike_price * 1000 AS BIGINT) AS VARCHAR))) AS INT), '0'), 1, 20)
               AS ticker
    FROM Option_Contract""")
def _(tables):
    rows = tables["Option_Contract"].withColumn("root", F.concat(F.lit("S"), F.col("underlying_id").cast("string")))
    return rows.select(
        "option_id", reference.option_symbol("root", "expiration_date", "option_type", "strike_price").alias("ticker")
    )


@case("ing_holding_resolve", sql="""
    SELECT portfolio_id, security_id, CAST(shares AS DOUBLE) AS shares, CAST(average_cost AS DOUBLE) AS average_cost
    FROM raw_holding JOIN Security USING (ticker)""")
def _(tables):
    rows = reference.resolve_holdings(tables["raw_holding"], tables["Security"])
    return rows.select("portfolio_id", "security_id", F.col("shares").cast("double").alias("shares"),
                       F.col("average_cost").cast("double").alias("average_cost"))


@case("ing_price_reshape", sql="SELECT security_id, trade_date, CAST(close AS DOUBLE) AS close, volume FROM Price")
def _(tables):
    slots = [f"P{i}" for i in range(WIDE_SLOTS)]
    rows = market.long_prices(tables["raw_price_wide"], slots, ["close", "volume"], keys=("block", "trade_date"))
    slot = F.substring("symbol", 2, 1).cast("long")
    return rows.select(
        (F.col("block") * WIDE_SLOTS + slot).alias("security_id"),
        "trade_date",
        F.col("close").cast("double").alias("close"),
        "volume",
    )


@case("ing_price_clean", sql="""
    SELECT security_id, trade_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
           CAST(close AS DOUBLE) AS close, CAST(COALESCE(volume, 0) AS BIGINT) AS volume
    FROM raw_price JOIN Security ON ticker = symbol WHERE close IS NOT NULL""")
def _(tables):
    rows = market.clean_prices(tables["raw_price"], tables["Security"])
    return rows.select("security_id", "trade_date", *[F.col(c).cast("double").alias(c) for c in market.OHLC], "volume")


@case("ing_etf_meta", sql="""
    SELECT symbol, COALESCE(NULLIF(long_name, ''), NULLIF(short_name, ''), 'Fund ' || symbol) AS fund_name,
           COALESCE(ROUND(COALESCE(NULLIF(expense_a, 0), NULLIF(expense_b, 0)) * 100, 4), 0.5) AS expense_ratio
    FROM raw_etf_info""")
def _(tables):
    info = tables["raw_etf_info"]
    funds = info.select("symbol", F.concat(F.lit("Fund "), F.col("symbol")).alias("name_fallback"),
                        F.lit(0.5).alias("expense_fallback"))
    return market.fund_metadata(funds, info)


@case("ing_option_nearest_strike", sql="""
    WITH best AS (
        SELECT t.option_id, c.implied_volatility, c.open_interest, c.strike,
               ROW_NUMBER() OVER (PARTITION BY t.option_id
                   ORDER BY ABS(c.strike - t.strike), c.strike, c.implied_volatility NULLS FIRST, c.open_interest NULLS FIRST) AS place
        FROM option_target t JOIN raw_chain c USING (underlying_id, expiration_date, option_type))
    SELECT t.option_id, t.expiration_date, t.option_type, CAST(t.strike AS DOUBLE) AS strike,
           CAST(COALESCE(b.implied_volatility, t.iv_fallback) AS DOUBLE) AS implied_volatility,
           CASE WHEN b.option_id IS NULL THEN t.oi_fallback ELSE COALESCE(b.open_interest, 0) END AS open_interest
    FROM option_target t LEFT JOIN (SELECT * FROM best WHERE place = 1) b USING (option_id)""")
def _(tables):
    return market.nearest_strikes(tables["option_target"], tables["raw_chain"]).select(
        "option_id", "expiration_date", "option_type", F.col("strike").cast("double").alias("strike"),
        "implied_volatility", "open_interest",
    )


@case("ing_fund_scope", sql=f"""{_CLEAN}
    SELECT 'full' AS mode, symbol FROM members
    UNION ALL SELECT 'daily', symbol FROM members
    WHERE symbol IN (SELECT REPLACE(ticker, 'S', 'S-') FROM Security JOIN Financial_Snapshot USING (security_id)
                     WHERE market_cap >= 100000000000)""")
def _(tables):
    members = _members(tables)
    large = tables["Financial_Snapshot"].filter(F.col("market_cap") >= 100_000_000_000).select("security_id")
    curated = tables["Security"].join(large, "security_id", "left_semi").select(
        F.replace("ticker", F.lit("S"), F.lit("S-")).alias("symbol")
    )
    full = market.fundamentals_scope(members, market.FULL)
    daily = market.fundamentals_scope(members, market.DAILY, curated)
    return full.select(F.lit("full").alias("mode"), "symbol").unionByName(
        daily.select(F.lit("daily").alias("mode"), "symbol")
    )


@case("ing_mode_by_weekday", sql="""
    SELECT trade_date, CASE WHEN DAYOFWEEK(trade_date) = 0 THEN 'full' ELSE 'daily' END AS mode
    FROM (SELECT DISTINCT trade_date FROM Price) AS days""")
def _(tables):
    days = tables["Price"].select("trade_date").distinct()
    return days.withColumn("mode", market.run_mode("trade_date"))


@case("ing_snapshot_clean", sql=f"""
    SELECT symbol, security_id, DATE '{END}' AS snapshot_date, CAST(market_cap AS DOUBLE) AS market_cap,
           ROUND(NULLIF(trailing_pe, 0), 2) AS pe_ratio, ROUND(NULLIF(trailing_eps, 0), 4) AS eps,
           ROUND(NULLIF(beta, 0), 4) AS beta
    FROM (SELECT ticker AS symbol, security_id FROM Security WHERE security_type = 'stock') AS wanted
    LEFT JOIN raw_info USING (symbol)""")
def _(tables):
    stocks = tables["Security"].filter(F.col("security_type") == "stock")
    scope = stocks.select(F.col("ticker").alias("symbol"))
    rows = market.clean_snapshots(scope, tables["raw_info"], stocks, END)
    return rows.withColumn("market_cap", F.col("market_cap").cast("double"))


@case("ing_action_classify", sql=f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY symbol, kind = 'split', action_date, value) AS BIGINT) AS action_id, security_id,
           action_date, CASE WHEN kind = 'dividend' THEN 'dividend' WHEN value > 1 THEN 'split' ELSE 'reverse_split' END
               AS action_type,
           CAST(value AS DOUBLE) AS amount
    FROM raw_action JOIN Security ON ticker = symbol
    WHERE action_date BETWEEN DATE '{START}' AND DATE '2000-12-31'""")
def _(tables):
    stocks = tables["Security"].filter(F.col("security_type") == "stock")
    scope = stocks.select(F.col("ticker").alias("symbol"))
    rows = market.classify_actions(tables["raw_action"], scope, stocks, START, "2000-12-31")
    return rows.withColumn("amount", F.col("amount").cast("double"))


@case("ing_date_defaults", sql="""
    SELECT today, flag, COALESCE(flag, CAST(today - INTERVAL 3 YEAR AS DATE)) AS first_day, DATE '2001-06-30' AS last_day
    FROM (SELECT DISTINCT trade_date AS today, CASE WHEN MONTH(trade_date) = 2 THEN trade_date - 10 END AS flag
          FROM Price) AS runs""")
def _(tables):
    """One range per run day: flag, else environment, else default."""
    runs = tables["Price"].select(F.col("trade_date").alias("today")).distinct()
    runs = runs.withColumn("flag", F.when(F.month("today") == 2, F.date_sub("today", 10)))
    first, last = market.date_range(F.col("flag"), None, F.col("today"), env={"PRICE_END": "2001-06-30"})
    return runs.select("today", "flag", first.alias("first_day"), last.alias("last_day"))


@case("ing_row_counts", sql=" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {n}" for n in LOAD_ORDER), with_ids=True)
def _(tables):
    return row_counts(tables)


# -- the whole chain ----------------------------------------------------------------


def _dashed(column):
    return F.replace(column, F.lit("S"), F.lit("S-"))


def _member(key):
    digits = F.col(key).cast("string")
    return F.concat(F.lit("S-"), F.lpad(digits, F.greatest(F.lit(5), F.length(digits)), F.lit("0")))


def _at_most(column, most):
    return F.when(F.col(column) > most, most).otherwise(F.col(column)).alias(column)


def delivered(tables):
    """Raw data as its providers name it: member symbols throughout."""
    info = tables["raw_etf_info"]
    return {
        "constituents": tables["raw_constituents"],
        "prices": tables["raw_price"].withColumn("symbol", _dashed("symbol")),
        "fund_info": info.select(F.concat(F.lit("F"), F.col("symbol")).alias("symbol"), "long_name", "short_name",
                                 _at_most("expense_a", 0.9), _at_most("expense_b", 0.9)),
        "chain": tables["raw_chain"].withColumn("underlying", _member("underlying_id")),
        "info": tables["raw_info"].withColumn("symbol", _dashed("symbol")),
        "actions": tables["raw_action"].withColumn("symbol", _dashed("symbol")),
    }


def chosen(tables):
    """Curated lists that grow with the given tables: a fund per supplier, contracts with symbols of their own."""
    funds = tables["raw_etf_info"].select(
        F.concat(F.lit("F"), F.col("symbol")).alias("symbol"), F.concat(F.lit("Fund "), F.col("symbol")).alias("name_fallback"),
        F.lit(0.5).alias("expense_fallback"))
    targets = tables["option_target"].withColumn("underlying", _member("underlying_id")).drop("underlying_id")
    named = targets.withColumn("ticker", reference.option_symbol("underlying", "expiration_date", "option_type", "strike"))
    first = named.groupBy("ticker").agg(F.min("option_id").alias("option_id")).select("option_id")
    options = assign_ids(targets.join(first, "option_id", "left_semi"), ["option_id"], "position", start=0)
    return pipeline.Curated(
        funds=assign_ids(funds, ["symbol"], "position", start=0),
        options=options.drop("option_id"),
        portfolios=tables["Portfolio"],
        holdings=tables["raw_holding"].withColumn("ticker", _dashed("ticker")),
    )


_PADDED = "LPAD(CAST({0} AS VARCHAR), CAST(GREATEST(5, LENGTH(CAST({0} AS VARCHAR))) AS INT), '0')"
_UNDERLYING = "'S-' || " + _PADDED.format("underlying_id")
_CHAIN = f"""{_LISTED},
    counted AS (SELECT CAST(COUNT(*) AS BIGINT) AS n FROM members),
    fund_list AS (
        SELECT ROW_NUMBER() OVER (ORDER BY symbol) AS place, 'F' || symbol AS symbol, symbol AS plain, long_name, short_name,
               CASE WHEN expense_a > 0.9 THEN 0.9 ELSE expense_a END AS expense_a,
               CASE WHEN expense_b > 0.9 THEN 0.9 ELSE expense_b END AS expense_b FROM raw_etf_info),
    option_named AS (
        SELECT *, {_UNDERLYING} AS underlying,
               SUBSTR({_UNDERLYING} || STRFTIME(expiration_date, '%Y%m%d') || CASE option_type WHEN 'call' THEN 'C' ELSE 'P' END
                      || LPAD(CAST(CAST(strike * 1000 AS BIGINT) AS VARCHAR),
                              CAST(GREATEST(8, LENGTH(CAST(CAST(strike * 1000 AS BIGINT) AS VARCHAR))) AS INT), '0'), 1, 20) AS ticker
        FROM option_target),
    option_first AS (SELECT * FROM option_named QUALIFY ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY option_id) = 1),
    option_list AS (SELECT * RENAME (option_id AS target_id), ROW_NUMBER() OVER (ORDER BY option_id) AS option_id FROM option_first),
    fund_count AS (SELECT CAST(COUNT(*) AS BIGINT) AS n FROM fund_list),
    listed AS (
        SELECT id AS security_id, symbol AS ticker, CASE WHEN symbol IN ({_NAMES}) THEN 2 ELSE 1 END AS exchange_id, 'USD' AS currency,
               'stock' AS security_type FROM numbered
        UNION ALL SELECT n + place, symbol, 2, 'USD', 'etf' FROM fund_list, counted),
    best AS (
        SELECT t.target_id, c.implied_volatility, c.open_interest,
               ROW_NUMBER() OVER (PARTITION BY t.target_id
                   ORDER BY ABS(c.strike - t.strike), c.strike, c.implied_volatility NULLS FIRST, c.open_interest NULLS FIRST) AS turn
        FROM option_list t JOIN raw_chain c USING (underlying_id, expiration_date, option_type) JOIN numbered ON symbol = underlying),
    made_Sector AS (SELECT * FROM sectors),
    made_Industry AS (SELECT * FROM industries),
    made_Company AS (
        SELECT id AS company_id, security AS company_name,
               (SELECT MAX(industry_id) FROM industries WHERE industry_name = sub_industry) AS industry_id, 'US' AS country FROM numbered),
    made_Exchange AS (SELECT * FROM (VALUES {", ".join(map(str, fixed.EXCHANGES))}) AS v(exchange_id, exchange_name, country, timezone)),
    made_Security AS (
        SELECT * FROM listed UNION ALL
        SELECT c.n + f.n + option_id, ticker, 3, 'USD', 'option' FROM option_list, counted c, fund_count f),
    made_Stock AS (SELECT id AS security_id, id AS company_id FROM numbered),
    made_ETF AS (
        SELECT n + place AS security_id, COALESCE(NULLIF(long_name, ''), NULLIF(short_name, ''), 'Fund ' || plain) AS fund_name,
               COALESCE(ROUND(COALESCE(NULLIF(expense_a, 0), NULLIF(expense_b, 0)) * 100, 4), 0.5) AS expense_ratio
        FROM fund_list, counted),
    made_Option_Contract AS (
        SELECT t.option_id, c.n + f.n + t.option_id AS security_id, t.expiration_date, t.strike AS strike_price, t.option_type,
               COALESCE(b.implied_volatility, t.iv_fallback) AS implied_volatility,
               CASE WHEN b.target_id IS NULL THEN t.oi_fallback ELSE COALESCE(b.open_interest, 0) END AS open_interest
        FROM option_list t LEFT JOIN (SELECT * FROM best WHERE turn = 1) b USING (target_id), counted c, fund_count f),
    made_Portfolio AS (SELECT * FROM Portfolio),
    made_Holding AS (
        SELECT portfolio_id, security_id, shares, average_cost FROM raw_holding h JOIN listed ON listed.ticker = REPLACE(h.ticker, 'S', 'S-')),
    made_Price AS (
        SELECT security_id, trade_date, open, high, low, close, COALESCE(volume, 0) AS volume
        FROM raw_price JOIN listed ON ticker = REPLACE(symbol, 'S', 'S-')
        WHERE close IS NOT NULL AND trade_date BETWEEN DATE '{START}' AND DATE '{END}'),
    made_Financial_Snapshot AS (
        SELECT id AS snapshot_id, id AS security_id, DATE '{END}' AS snapshot_date, market_cap, ROUND(NULLIF(trailing_pe, 0), 2) AS pe_ratio,
               ROUND(NULLIF(trailing_eps, 0), 4) AS eps, ROUND(NULLIF(beta, 0), 4) AS beta
        FROM numbered LEFT JOIN raw_info ON REPLACE(raw_info.symbol, 'S', 'S-') = numbered.symbol),
    made_Corporate_Action AS (
        SELECT ROW_NUMBER() OVER (ORDER BY numbered.symbol, kind = 'split', action_date, value) AS action_id, id AS security_id, action_date,
               CASE WHEN kind = 'dividend' THEN 'dividend' WHEN value > 1 THEN 'split' ELSE 'reverse_split' END AS action_type, value AS amount
        FROM raw_action JOIN numbered ON REPLACE(raw_action.symbol, 'S', 'S-') = numbered.symbol
        WHERE action_date BETWEEN DATE '{START}' AND DATE '{END}')"""


@case("ing_pipeline", sql=f"{_CHAIN} " + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, {line_sql(n)} AS line FROM made_{n}" for n in LOAD_ORDER))
def _(tables):
    """Landed files to the checked store, in one chain; every row of the thirteen tables as text."""
    spark = tables.spark
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "store")
    pipeline.land(delivered(tables), landing)
    pipeline.load(spark, landing, root, chosen(tables), mode=market.FULL, start=START, end=END)
    loaded = store.open_store(spark, root)
    lines = [loaded[n].select(F.lit(n).alias("table_name"), key_text(TABLES[n].columns).alias("line")) for n in LOAD_ORDER]
    return reduce(DataFrame.unionByName, lines)
