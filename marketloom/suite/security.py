"""Registered single-security analyses.

Each comes in the parameterised form and, as ``*_universe``, for all securities
at once, which is the form meant for large tables.
"""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from marketloom.plans import security as plan
from marketloom.suite.derived_sql import pct, rounded
from marketloom.suite.registry import AS_OF, END, START, TICKER, case

_RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"
_ONE = f"ticker = '{TICKER}'"

# Each text is written over all securities, with a place for the ticker filter
# and for the ticker column.
_LAGGED = """
    lagged AS (
        SELECT security_id, trade_date, close,
               LAG(close) OVER (PARTITION BY security_id ORDER BY trade_date) AS before
        FROM Price {inside})"""
_CHANGE = "CAST(close - before AS DOUBLE) / NULLIF(CAST(before AS DOUBLE), 0)"

_SQL = {
    "s1_close_series": f"""
        SELECT {{label}} trade_date, CAST(close AS DOUBLE) AS close
        FROM Price JOIN Security USING (security_id)
        WHERE trade_date {_RANGE} AND {{only}}""",
    "q01_daily_return": f"""WITH {_LAGGED.format(inside='')}
        SELECT {{label}} trade_date, CAST(close AS DOUBLE) AS close,
               {rounded(pct('close', 'before'), 2)} AS daily_return_pct
        FROM lagged JOIN Security USING (security_id)
        WHERE before IS NOT NULL AND trade_date {_RANGE} AND {{only}}""",
    "s2_rolling_vol": f"""WITH {_LAGGED.format(inside=f'WHERE trade_date {_RANGE}')},
        moved AS (SELECT security_id, trade_date, {_CHANGE} AS ret FROM lagged),
        framed AS (
            SELECT security_id, trade_date,
                   STDDEV_SAMP(ret) OVER (PARTITION BY security_id ORDER BY trade_date
                                          ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS dev
            FROM moved WHERE ret IS NOT NULL)
        SELECT {{label}} trade_date, {rounded('dev * SQRT(CAST(252 AS DOUBLE)) * 100', 2)} AS ann_vol_pct
        FROM framed JOIN Security USING (security_id) WHERE {{only}}""",
    "q02_rolling_vol_calendar": f"""WITH {_LAGGED.format(inside='')},
        moved AS (SELECT security_id, trade_date, {_CHANGE} AS ret FROM lagged),
        framed AS (
            SELECT security_id, trade_date,
                   STDDEV_POP(ret) OVER (PARTITION BY security_id ORDER BY trade_date
                                         RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS dev
            FROM moved)
        SELECT {{label}} trade_date, {rounded('dev * SQRT(CAST(252 AS DOUBLE)) * 100', 2)} AS rolling_vol_pct
        FROM framed JOIN Security USING (security_id) WHERE trade_date {_RANGE} AND {{only}}""",
    "s6_snapshot_trend": f"""
        SELECT {{label}} snapshot_date, CAST(pe_ratio AS DOUBLE) AS pe_ratio, CAST(eps AS DOUBLE) AS eps,
               CAST(beta AS DOUBLE) AS beta, {rounded('CAST(market_cap AS DOUBLE) / 1e9', 2)} AS market_cap_b
        FROM Financial_Snapshot JOIN Security USING (security_id) WHERE {{only}}""",
    "q06_snapshot_trend": """
        SELECT {label} snapshot_date, CAST(pe_ratio AS DOUBLE) AS pe_ratio, CAST(eps AS DOUBLE) AS eps,
               CAST(beta AS DOUBLE) AS beta
        FROM Financial_Snapshot JOIN Security USING (security_id) WHERE {only}""",
}

# As-of lookups on the other side use the engine's own as-of join.
_EVENTS = """WITH shifted AS (
        SELECT *, action_date - 7 AS early, action_date + 7 AS late FROM Corporate_Action),
    on_day AS (
        SELECT s.*, p.close AS price_on_date FROM shifted s
        ASOF LEFT JOIN Price p ON s.security_id = p.security_id AND s.action_date >= p.trade_date),
    with_early AS (
        SELECT o.*, p.close AS price_7d_before FROM on_day o
        ASOF LEFT JOIN Price p ON o.security_id = p.security_id AND o.early >= p.trade_date),
    with_late AS (
        SELECT w.*, p.close AS price_7d_after FROM with_early w
        ASOF LEFT JOIN Price p ON w.security_id = p.security_id AND w.late <= p.trade_date)"""
_EVENT_PRICES = ("CAST(amount AS DOUBLE) AS amount, CAST(price_on_date AS DOUBLE) AS price_on_date, "
                 "CAST(price_7d_before AS DOUBLE) AS price_7d_before, CAST(price_7d_after AS DOUBLE) AS price_7d_after")
_SQL["s4_action_impact"] = f"""{_EVENTS}
    SELECT {{label}} action_date, action_type, {_EVENT_PRICES},
           {rounded(pct('price_on_date', 'price_7d_before'), 2)} AS chg_pre_pct,
           {rounded(pct('price_7d_after', 'price_on_date'), 2)} AS chg_aft_pct
    FROM with_late JOIN Security USING (security_id) WHERE {{only}}"""
_SQL["q04_action_impact_span"] = f"""{_EVENTS}
    SELECT {{label}} action_type, action_date, {_EVENT_PRICES},
           {rounded(pct('price_7d_after', 'price_7d_before'), 2)} AS pct_change_over_event
    FROM with_late JOIN Security USING (security_id) WHERE {{only}}"""

_ENDS = f"""ends AS (
        SELECT security_id,
               ARG_MIN(close, trade_date) FILTER (WHERE trade_date >= DATE '{START}') AS opening,
               ARG_MAX(close, trade_date) FILTER (WHERE trade_date <= DATE '{END}') AS closing
        FROM Price GROUP BY security_id),
    gains AS (
        SELECT security_id, ticker, {pct('closing', 'opening')} AS gain
        FROM ends JOIN Security USING (security_id)
        WHERE opening IS NOT NULL AND closing IS NOT NULL)"""
_SQL["s5_return_vs_benchmark"] = f"""WITH {_ENDS}
    SELECT {{label}} {rounded('own.gain', 2)} AS stock_return_pct, {rounded('spy.gain', 2)} AS spy_return_pct,
           {rounded('own.gain - spy.gain', 2)} AS excess_return_pct
    FROM gains own JOIN gains spy ON spy.ticker = 'SPY' WHERE own.{{only}}"""

_IV = """{source}
    SELECT expiration_date, option_type, CAST(COUNT(*) AS BIGINT) AS {count}, {measures}
    FROM Option_Contract JOIN Security USING (security_id)
    WHERE {only} GROUP BY expiration_date, option_type"""


def _register(name, fn, label_alone="", **params):
    text = _SQL[name]
    column = "own.ticker," if "own." in text else "ticker,"

    @case(name, sql=text.format(label=label_alone, only=_ONE))
    def _(tables):
        return fn(tables, ticker=TICKER, **params)

    @case(f"{name}_universe", sql=text.format(label=column, only="ticker IS NOT NULL"))
    def _(tables):
        return fn(tables, ticker=None, **params)


_RANGE_ARGS = {"start": START, "end": END}
_register("s1_close_series", plan.close_series, **_RANGE_ARGS)
_register("q01_daily_return", plan.daily_return, **_RANGE_ARGS)
_register("s2_rolling_vol", plan.rolling_volatility, **_RANGE_ARGS)
_register("q02_rolling_vol_calendar", plan.rolling_volatility_calendar, **_RANGE_ARGS)
_register("s4_action_impact", plan.action_impact)
_register("q04_action_impact_span", plan.action_impact_span)
_register("s5_return_vs_benchmark", plan.return_vs_benchmark, **_RANGE_ARGS)
_SQL["q05_return_vs_benchmark"] = _SQL["s5_return_vs_benchmark"]
_register("q05_return_vs_benchmark", plan.return_vs_benchmark_named, label_alone="own.ticker,", **_RANGE_ARGS)
_register("s6_snapshot_trend", plan.snapshot_trend)
_register("q06_snapshot_trend", plan.snapshot_measures)

_TERM = (f"{rounded('AVG(CAST(implied_volatility AS DOUBLE)) * 100', 2)} AS avg_iv_pct, "
         "CAST(SUM(open_interest) AS BIGINT) AS total_oi")
_ACTIVE = ", ".join(
    f"{rounded(f'{agg}(CAST(implied_volatility AS DOUBLE))', 4)} AS {agg.lower()}_iv" for agg in ("AVG", "MIN", "MAX")
)


@case("s3_iv_term", sql=_IV.format(source="", count="contracts", measures=_TERM, only=f"ticker LIKE '{TICKER}%'"))
def _(tables):
    return plan.iv_term_structure(tables, ticker=TICKER)


@case("s3_iv_term_universe", sql=_IV.format(source="", count="contracts", measures=_TERM, only="TRUE"))
def _(tables):
    return plan.iv_term_structure(tables, ticker="")


@case("q03_iv_active", sql=_IV.format(
    source="", count="contract_count", measures=_ACTIVE,
    only=f"ticker = 'S00003O3' AND expiration_date >= DATE '2001-01-01'"))
def _(tables):
    return plan.iv_active(tables, ticker="S00003O3", as_of="2001-01-01")


@case("q03_iv_active_universe", sql=_IV.format(
    source="", count="contract_count", measures=_ACTIVE, only=f"expiration_date >= DATE '{AS_OF}'"))
def _(tables):
    return plan.iv_active(tables, ticker=None, as_of=AS_OF)


@case("s1_close_series_to_today", sql=f"""
    SELECT trade_date, CAST(close AS DOUBLE) AS close FROM Price JOIN Security USING (security_id)
    WHERE ticker = '{TICKER}' AND trade_date BETWEEN DATE '{START}' AND CURRENT_DATE""")
def _(tables):
    """A range without an end reaches to today."""
    return plan.close_series(tables, ticker=TICKER, start=START)


_MOVED = """WITH moved AS (
    SELECT * REPLACE (expiration_date + CAST(CURRENT_DATE - DATE '2001-06-15' AS INTEGER) AS expiration_date) FROM Option_Contract)"""


@case("q03_iv_active_today", sql=_IV.format(
    source=_MOVED, count="contract_count", measures=_ACTIVE, only="expiration_date >= CURRENT_DATE"
).replace("FROM Option_Contract JOIN", "FROM moved JOIN"))
def _(tables):
    """Contracts not expired today, of a chain whose second expiry is today."""
    shift = F.datediff(F.current_date(), F.lit("2001-06-15").cast("date"))
    moved = tables["Option_Contract"].withColumn("expiration_date", F.date_add("expiration_date", shift))
    return plan.iv_active(ChainMap({"Option_Contract": moved}, tables), ticker=None)
