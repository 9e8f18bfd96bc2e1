"""Registered portfolio operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.plans import portfolio as plan
from marketloom.session import scratch_path
from marketloom.sources import store
from marketloom.suite.derived_sql import rounded
from marketloom.suite.registry import AS_OF, END, OWNER, PORTFOLIO, START, case

_NUMBER = r"'^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?'"


def _number(text):
    return f"COALESCE(TRY_CAST(TRIM(REGEXP_EXTRACT({text}, {_NUMBER}, 0)) AS DOUBLE), 0)"


def _entries(source, key, spec):
    """CTEs that end in ``entries``: parsed, one row per key and ticker."""
    return f"""pieces AS (
        SELECT {key}, UNNEST(STRING_SPLIT({spec}, ',')) AS piece,
               UNNEST(RANGE(LEN(STRING_SPLIT({spec}, ',')))) AS position
        FROM {source}),
    fields AS (SELECT {key}, position, STRING_SPLIT(piece, ':') AS f FROM pieces),
    numbers AS (
        SELECT {key}, position, UPPER(TRIM(f[1])) AS ticker, {_number('f[2]')} AS shares,
               CASE WHEN LEN(f) > 2 THEN {_number('f[3]')} ELSE 0 END AS cost
        FROM fields WHERE LEN(f) >= 2),
    entries AS (
        SELECT {key}, ticker, ARG_MAX(shares, position) AS shares, ARG_MAX(cost, position) AS cost,
               CAST(MIN(position) AS BIGINT) AS position
        FROM numbers WHERE ticker <> '' AND shares > 0 GROUP BY {key}, ticker)"""


_REFERENCE = f"""lowest AS (SELECT UPPER(ticker) AS ticker, MIN(security_id) AS security_id FROM Security GROUP BY 1),
    quote AS (SELECT security_id, ARG_MAX(close, trade_date) AS close FROM Price GROUP BY security_id),
    paid AS (SELECT security_id, SUM(amount) AS dividends FROM Corporate_Action
             WHERE action_type = 'dividend' AND action_date >= DATE '{AS_OF}' - INTERVAL 1 YEAR GROUP BY security_id),
    facts AS (
        SELECT l.ticker, l.security_id, s.security_type, c.company_name, e.sector_name,
               CAST(q.close AS DOUBLE) AS latest_close, COALESCE(CAST(d.dividends AS DOUBLE), 0) AS div12
        FROM lowest l JOIN Security s ON s.security_id = l.security_id
        LEFT JOIN Stock k ON k.security_id = l.security_id
        LEFT JOIN Company c ON c.company_id = k.company_id
        LEFT JOIN Industry i ON i.industry_id = c.industry_id
        LEFT JOIN Sector e ON e.sector_id = i.sector_id
        LEFT JOIN quote q ON q.security_id = l.security_id
        LEFT JOIN paid d ON d.security_id = l.security_id)"""

_SAVED = """held AS (
        SELECT portfolio_id, UPPER(ticker) AS ticker, CAST(shares AS DOUBLE) AS shares,
               CAST(average_cost AS DOUBLE) AS cost, security_id AS position
        FROM Holding JOIN Security USING (security_id))"""

_VALUED = f"""SELECT h.portfolio_id, h.ticker,
           COALESCE(company_name, CASE WHEN security_type = 'etf' THEN 'ETF' END) AS company_name,
           CASE WHEN security_id IS NULL THEN 'Unknown ticker' WHEN sector_name IS NOT NULL THEN sector_name
                WHEN security_type = 'etf' THEN 'ETF / Fund' ELSE 'Other' END AS sector_name,
           {rounded('shares', 4)} AS shares, {rounded('cost', 4)} AS avg_cost,
           {rounded('latest_close', 2)} AS latest_close, {rounded('latest_close * shares', 2)} AS market_value,
           {rounded('cost * shares', 2)} AS cost_basis,
           {rounded('latest_close * shares - cost * shares', 2)} AS unrealized_pl,
           CASE WHEN cost * shares > 0 THEN
               {rounded('(latest_close * shares - cost * shares) / (cost * shares) * 100', 2)} END AS unrealized_pl_pct,
           COALESCE({rounded('div12 * shares', 2)}, 0) AS div_income_12mo"""

_SERIES = f"""SELECT portfolio_id, trade_date,
           {rounded('SUM(CAST(close AS DOUBLE) * shares)', 2)} AS port_value
    FROM Price JOIN lowest USING (security_id) JOIN {{held}} USING (ticker)
    WHERE trade_date BETWEEN DATE '{START}' AND DATE '{END}' {{only}}
    GROUP BY portfolio_id, trade_date"""


@case("pf_list", sql=f"""
    SELECT portfolio_id, portfolio_name, owner_name,
           CASE WHEN LOWER(owner_name) LIKE 'u:%' THEN 0 ELSE 1 END AS is_sample,
           (SELECT COUNT(*) FROM Holding h WHERE h.portfolio_id = p.portfolio_id) AS holdings
    FROM Portfolio p
    WHERE LOWER(owner_name) NOT LIKE 'u:%' OR owner_name = '{OWNER}'""")
def _(tables):
    return plan.list_portfolios(tables, owner=OWNER)


@case("pf_parse_spec", sql=f"WITH {_entries('pf_spec', 'spec_id', 'spec')} SELECT * FROM entries")
def _(tables):
    return plan.parse_specs(tables["pf_spec"])


@case("pf_resolve_saved", sql=f"WITH {_SAVED} SELECT * FROM held WHERE portfolio_id = {PORTFOLIO}")
def _(tables):
    return plan.resolve_holdings(tables, PORTFOLIO, tables["pf_spec"])


@case("pf_resolve_saved_universe", sql=f"WITH {_SAVED} SELECT * FROM held")
def _(tables):
    return plan.saved_holdings(tables)


@case("pf_reference", sql=f"WITH {_REFERENCE} SELECT * FROM facts")
def _(tables):
    return plan.reference(tables, as_of=AS_OF)


@case("pf_holdings", sql=f"WITH {_REFERENCE}, {_SAVED} {_VALUED} FROM held h LEFT JOIN facts USING (ticker) "
                         f"WHERE h.portfolio_id = {PORTFOLIO}")
def _(tables):
    return plan.value_holdings(tables, plan.resolve_holdings(tables, PORTFOLIO), as_of=AS_OF, few=True)


@case("pf_holdings_universe",
      sql=f"WITH {_REFERENCE}, {_SAVED} {_VALUED} FROM held h LEFT JOIN facts USING (ticker)")
def _(tables):
    return plan.value_holdings(tables, plan.saved_holdings(tables), as_of=AS_OF)


@case("pf_holdings_spec", sql=f"""WITH {_REFERENCE}, {_entries('pf_spec', 'spec_id', 'spec')},
    held AS (SELECT spec_id AS portfolio_id, ticker, shares, cost FROM entries)
    {_VALUED} FROM held h LEFT JOIN facts USING (ticker)""")
def _(tables):
    return plan.value_holdings(tables, plan.resolve_holdings(tables, specs=tables["pf_spec"]), as_of=AS_OF)


@case("pf_series", sql=f"WITH {_REFERENCE}, {_SAVED} "
                       + _SERIES.format(held="held", only=f"AND portfolio_id = {PORTFOLIO}"))
def _(tables):
    return plan.value_series(tables, plan.resolve_holdings(tables, PORTFOLIO), start=START, end=END, few=True)


@case("pf_series_universe", sql=f"WITH {_REFERENCE}, {_SAVED} " + _SERIES.format(held="held", only=""))
def _(tables):
    return plan.value_series(tables, plan.saved_holdings(tables), start=START, end=END)


@case("pf_series_spec", sql=f"""WITH {_REFERENCE}, {_entries('pf_spec', 'spec_id', 'spec')},
    held AS (SELECT spec_id AS portfolio_id, ticker, shares FROM entries)
    {_SERIES.format(held='held', only='')}""")
def _(tables):
    return plan.value_series(tables, plan.resolve_holdings(tables, specs=tables["pf_spec"]), start=START, end=END)


_CHECKED = f"""{_entries('pf_save_request', 'request_id', 'holdings')},
    asked AS (
        SELECT r.request_id, TRIM(r.owner) AS owner, r.portfolio_id AS asked_id,
               CASE WHEN TRIM(r.name) = '' THEN 'My Portfolio' ELSE TRIM(r.name) END AS name,
               CASE WHEN TRIM(r.owner) NOT LIKE 'u:%' THEN 'invalid owner'
                    WHEN r.request_id NOT IN (SELECT request_id FROM entries) THEN 'no valid holdings'
                    WHEN r.portfolio_id > 0 AND (p.owner_name IS NULL OR p.owner_name <> TRIM(r.owner))
                        THEN 'not your portfolio' END AS error
        FROM pf_save_request r LEFT JOIN Portfolio p ON p.portfolio_id = r.portfolio_id)"""
_SAVING = f"""{_CHECKED},
    accepted AS (
        SELECT *, CASE WHEN asked_id > 0 THEN asked_id ELSE
                   (SELECT MAX(portfolio_id) FROM Portfolio)
                   + ROW_NUMBER() OVER (PARTITION BY asked_id > 0 ORDER BY request_id) END AS portfolio_id
        FROM asked WHERE error IS NULL),
    lowest AS (SELECT UPPER(ticker) AS ticker, MIN(security_id) AS security_id FROM Security GROUP BY 1),
    stored AS (
        SELECT request_id, portfolio_id, security_id, shares, GREATEST(cost, 0) AS average_cost
        FROM accepted JOIN entries USING (request_id) JOIN lowest USING (ticker)
        WHERE CAST(shares AS DECIMAL(14,4)) > 0)"""


@case("pf_save", sql=f"""WITH {_SAVING}
    SELECT request_id, CAST(portfolio_id AS BIGINT) AS portfolio_id,
           (SELECT COUNT(*) FROM stored s WHERE s.request_id = a.request_id) AS saved
    FROM accepted a""")
def _(tables):
    return plan.save_portfolios(tables, tables["pf_save_request"]).report


@case("pf_save_portfolios", sql=f"""WITH {_SAVING}
    SELECT p.portfolio_id, COALESCE(a.name, p.portfolio_name) AS portfolio_name, p.owner_name
    FROM Portfolio p LEFT JOIN (SELECT * FROM accepted WHERE asked_id > 0) a ON a.asked_id = p.portfolio_id
    UNION ALL SELECT CAST(portfolio_id AS BIGINT), name, owner FROM accepted WHERE asked_id <= 0""")
def _(tables):
    return plan.save_portfolios(tables, tables["pf_save_request"]).portfolio


_HOLDING_COLUMNS = ("CAST({p} AS BIGINT) AS portfolio_id, security_id, CAST(shares AS DOUBLE) AS shares, "
                    "CAST(average_cost AS DOUBLE) AS average_cost")


_SAVED_HOLDINGS = f"""WITH {_SAVING}
    SELECT {_HOLDING_COLUMNS.format(p='portfolio_id')} FROM Holding
    WHERE portfolio_id NOT IN (SELECT asked_id FROM accepted WHERE asked_id > 0)
    UNION ALL SELECT {_HOLDING_COLUMNS.format(p='portfolio_id')} FROM stored"""


def _stored(tables, change):
    """Holdings read back after committing a change of portfolios to a store of the tables."""
    root = scratch_path(tables.spark, "store")
    store.full_refresh(tables.spark, tables, root)
    current = store.open_store(tables.spark, root)
    saved = change(current, tables["pf_save_request"])
    store.commit_tables(tables.spark, {"Portfolio": saved.portfolio, "Holding": saved.holding}, root, based_on=1)
    return _as_double(store.open_store(tables.spark, root)["Holding"])


@case("pf_save_stored", sql=_SAVED_HOLDINGS, with_ids=True)
def _(tables):
    return _stored(tables, plan.save_portfolios)


@case("pf_save_holdings", sql=_SAVED_HOLDINGS)
def _(tables):
    return _as_double(plan.save_portfolios(tables, tables["pf_save_request"]).holding)


@case("pf_save_errors", sql=f"WITH {_CHECKED} SELECT request_id, error FROM asked WHERE error IS NOT NULL")
def _(tables):
    return plan.save_errors(tables, tables["pf_save_request"])


_DELETING = """hits AS (
        SELECT r.request_id, p.portfolio_id FROM pf_save_request r JOIN Portfolio p ON p.portfolio_id = r.portfolio_id
        WHERE r.owner LIKE 'u:%' AND r.portfolio_id > 0 AND LOWER(p.owner_name) = LOWER(r.owner))"""


@case("pf_delete", sql=f"""WITH {_DELETING}
    SELECT request_id,
           CASE WHEN owner LIKE 'u:%' AND portfolio_id > 0
                THEN CAST(request_id IN (SELECT request_id FROM hits) AS BIGINT) END AS deleted,
           CASE WHEN owner NOT LIKE 'u:%' OR portfolio_id <= 0 THEN 'bad request' END AS error
    FROM pf_save_request""")
def _(tables):
    return plan.delete_portfolios(tables, tables["pf_save_request"]).report


@case("pf_delete_portfolios", sql=f"""WITH {_DELETING}
    SELECT * FROM Portfolio WHERE portfolio_id NOT IN (SELECT portfolio_id FROM hits)""")
def _(tables):
    return plan.delete_portfolios(tables, tables["pf_save_request"]).portfolio


_LEFT_HOLDINGS = f"""WITH {_DELETING}
    SELECT {_HOLDING_COLUMNS.format(p='portfolio_id')} FROM Holding
    WHERE portfolio_id NOT IN (SELECT portfolio_id FROM hits)"""


@case("pf_delete_stored", sql=_LEFT_HOLDINGS, with_ids=True)
def _(tables):
    return _stored(tables, plan.delete_portfolios)


@case("pf_delete_holdings", sql=_LEFT_HOLDINGS)
def _(tables):
    return _as_double(plan.delete_portfolios(tables, tables["pf_save_request"]).holding)


def _as_double(rows):
    return rows.select("portfolio_id", "security_id", *[
        F.col(c).cast("double").alias(c) for c in ("shares", "average_cost")
    ])
