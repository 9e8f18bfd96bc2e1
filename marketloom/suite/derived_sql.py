"""The derived relations as SQL for the comparison engine (same definitions as FIXTURES.md)."""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {
    "Sector": """
        SELECT r_regionkey AS sector_id, r_name AS sector_name
        FROM region
    """,
    "Industry": """
        SELECT n_nationkey AS industry_id, n_name AS industry_name, n_regionkey AS sector_id
        FROM nation
    """,
    "Company": """
        SELECT s_suppkey AS company_id, s_name AS company_name, s_nationkey AS industry_id, 'US' AS country
        FROM supplier
    """,
    "Exchange": """
        SELECT 1 AS exchange_id, 'X1' AS exchange_name, 'US' AS country, 'America/New_York' AS timezone
        UNION ALL SELECT 2, 'X2', 'US', 'America/New_York'
        UNION ALL SELECT 3, 'X3', 'US', 'America/Chicago'
    """,
    "Stock": """
        SELECT s_suppkey AS security_id, s_suppkey AS company_id
        FROM supplier
    """,
    "ETF": """
        SELECT CAST(-1 AS BIGINT) AS security_id, 'Market Basket' AS fund_name, CAST(0.0945 AS DECIMAL(6,4)) AS expense_ratio
        UNION ALL SELECT CAST(-2 AS BIGINT), 'Promo Basket', CAST(0.2 AS DECIMAL(6,4))
    """,
    "Option_Contract": """
        SELECT p_partkey AS option_id, -10 - p_partkey AS security_id, p_partkey % (SELECT COUNT(*) FROM supplier) AS underlying_id, CAST(CASE p_size % 4 WHEN 0 THEN '2001-03-16' WHEN 1 THEN '2001-06-15' WHEN 2 THEN '2001-12-21' ELSE '2002-06-21' END AS DATE) AS expiration_date, CAST(p_retailprice AS DECIMAL(12,2)) AS strike_price, CASE WHEN p_type IN ('PROMO','SMALL','LARGE') THEN 'call' ELSE 'put' END AS option_type, CAST(p_size / 100.0 AS DECIMAL(8,4)) AS implied_volatility, CAST(p_partkey * 7 % 1000 AS INT) AS open_interest
        FROM part
    """,
    "Security": """
        SELECT s_suppkey AS security_id, 'S' || LPAD(CAST(s_suppkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(s_suppkey AS STRING))) AS INT), '0') AS ticker, 1 + CAST(s_suppkey % 2 AS INT) AS exchange_id, 'USD' AS currency, 'stock' AS security_type
        FROM supplier
        UNION ALL SELECT security_id, CASE WHEN fund_name = 'Market Basket' THEN 'SPY' ELSE 'PRM' END, 2, 'USD', 'etf'
        FROM ETF
        UNION ALL SELECT security_id, 'S' || LPAD(CAST(underlying_id AS STRING), CAST(GREATEST(5, LENGTH(CAST(underlying_id AS STRING))) AS INT), '0') || 'O' || CAST(option_id AS STRING), 3, 'USD', 'option'
        FROM Option_Contract
    """,
    "ticks": """
        SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS trade_date, l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(12,4)) AS px, CAST(l_quantity AS BIGINT) AS qty, l_returnflag, CAST(l_discount AS DECIMAL(6,4)) AS disc, CAST(l_tax AS DECIMAL(6,4)) AS tax, CAST(l_extendedprice AS DECIMAL(14,2)) AS amt
        FROM lineitem
    """,
    "ranked": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY security_id, trade_date ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn_a, ROW_NUMBER() OVER (PARTITION BY security_id, trade_date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rn_d
        FROM ticks
    """,
    "Price": """
        SELECT security_id, trade_date, MAX(CASE WHEN rn_a = 1 THEN px END) AS open, MAX(px) AS high, MIN(px) AS low, MAX(CASE WHEN rn_d = 1 THEN px END) AS close, CAST(SUM(qty) AS BIGINT) AS volume
        FROM ranked
        GROUP BY security_id, trade_date
        UNION ALL SELECT CAST(-1 AS BIGINT), trade_date, MIN(px), MAX(px), MIN(px), MAX(px), CAST(SUM(qty) AS BIGINT)
        FROM ticks
        GROUP BY trade_date
    """,
    "snap": """
        SELECT security_id, MAX(trade_date) AS snapshot_date, CAST(SUM(qty) AS BIGINT) * CASE security_id % 5 WHEN 0 THEN 1000000000 WHEN 1 THEN 100000000 WHEN 2 THEN 10000000 WHEN 3 THEN 1000000 ELSE 100000 END AS market_cap, CAST(CAST(SUM(disc) * 1000000 AS BIGINT) // COUNT(*) * 0.0001 AS DECIMAL(10,4)) AS eps, CAST(SUM(qty) AS BIGINT) AS qty, COUNT(*) AS n
        FROM ticks
        GROUP BY security_id, EXTRACT(YEAR FROM trade_date), EXTRACT(QUARTER FROM trade_date)
    """,
    "Financial_Snapshot": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY security_id, snapshot_date) AS BIGINT) AS snapshot_id, security_id, snapshot_date, market_cap, CASE WHEN security_id % 11 = 10 THEN NULL WHEN security_id % 13 = 12 THEN CAST(-1.5 AS DECIMAL(10,2)) ELSE CAST(qty * 25 // n * 0.05 AS DECIMAL(10,2)) END AS pe_ratio, CASE WHEN n % 17 = 0 THEN NULL ELSE eps END AS eps, CAST(qty * 200 // n * 0.0005 AS DECIMAL(6,4)) AS beta
        FROM snap
    """,
    "Corporate_Action": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY security_id, trade_date, l_orderkey, l_linenumber, l_partkey) AS BIGINT) AS action_id, security_id, trade_date AS action_date, CASE WHEN l_linenumber <= 5 THEN 'dividend' WHEN l_linenumber = 6 THEN 'split' ELSE 'reverse_split' END AS action_type, CASE WHEN l_linenumber <= 5 THEN CAST(disc * 10 AS DECIMAL(14,6)) WHEN l_linenumber = 6 THEN CAST(2 AS DECIMAL(14,6)) ELSE CAST(0.5 AS DECIMAL(14,6)) END AS amount
        FROM ticks
        WHERE l_returnflag = 'R'
    """,
    "Portfolio": """
        SELECT c_custkey AS portfolio_id, c_name AS portfolio_name, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'u:' || CAST(c_custkey % 10 AS STRING) ELSE c_mktsegment END AS owner_name
        FROM customer
    """,
    "Holding": """
        SELECT o_custkey AS portfolio_id, l_suppkey AS security_id, CAST(SUM(CAST(l_quantity AS BIGINT)) AS DECIMAL(14,4)) AS shares, CAST(MIN(l_extendedprice) AS DECIMAL(12,4)) AS average_cost
        FROM orders
        JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY o_custkey, l_suppkey
    """,
    "raw_constituents": """
        SELECT CAST(s_suppkey AS BIGINT) AS ordinal, ' S.' || LPAD(CAST(s_suppkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(s_suppkey AS STRING))) AS INT), '0') || ' ' AS symbol, s_name AS security, CASE WHEN s_suppkey % 9 = 8 THEN NULL ELSE r_name END AS sector, n_name AS sub_industry
        FROM supplier
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 1000000 + CAST(s_suppkey AS BIGINT), 'S.' || LPAD(CAST(s_suppkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(s_suppkey AS STRING))) AS INT), '0'), 'Duplicate', 'DUP', 'DUP'
        FROM supplier
        WHERE s_suppkey % 7 = 0
    """,
    "raw_price": """
        SELECT 'S' || LPAD(CAST(security_id AS STRING), CAST(GREATEST(5, LENGTH(CAST(security_id AS STRING))) AS INT), '0') AS symbol, trade_date, open, high, low, CASE WHEN volume % 23 = 0 THEN NULL ELSE close END AS close, CASE WHEN volume % 19 = 0 THEN NULL ELSE CAST(volume AS DOUBLE) END AS volume
        FROM Price
        WHERE security_id <> -1
        UNION ALL SELECT 'UNKNOWN', trade_date, open, high, low, close, CAST(volume AS DOUBLE)
        FROM Price
        WHERE security_id = 0
    """,
    "raw_price_wide": """
        SELECT CAST(FLOOR(security_id / 8.0) AS BIGINT) AS block, trade_date, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 0 THEN close END) AS P0_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 0 THEN volume END) AS P0_volume, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 1 THEN close END) AS P1_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 1 THEN volume END) AS P1_volume, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 2 THEN close END) AS P2_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 2 THEN volume END) AS P2_volume, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 3 THEN close END) AS P3_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 3 THEN volume END) AS P3_volume, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 4 THEN close END) AS P4_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 4 THEN volume END) AS P4_volume, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 5 THEN close END) AS P5_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 5 THEN volume END) AS P5_volume, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 6 THEN close END) AS P6_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 6 THEN volume END) AS P6_volume, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 7 THEN close END) AS P7_close, MAX(CASE WHEN (security_id % 8 + 8) % 8 = 7 THEN volume END) AS P7_volume
        FROM Price
        GROUP BY ALL
    """,
    "raw_info": """
        SELECT 'S' || LPAD(CAST(s_suppkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(s_suppkey AS STRING))) AS INT), '0') AS symbol, CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE s_suppkey * 1000003 END AS market_cap, CASE WHEN s_suppkey % 5 = 4 THEN CAST(0 AS DOUBLE) ELSE CAST(s_suppkey AS DOUBLE) + 0.125 END AS trailing_pe, CASE WHEN s_suppkey % 8 = 7 THEN NULL ELSE CAST(s_suppkey AS DOUBLE) * 0.5 END AS trailing_eps, CAST(s_suppkey % 3 AS DOUBLE) AS beta
        FROM supplier
    """,
    "raw_action": """
        SELECT 'S' || LPAD(CAST(security_id AS STRING), CAST(GREATEST(5, LENGTH(CAST(security_id AS STRING))) AS INT), '0') AS symbol, action_date, CASE WHEN action_type = 'dividend' THEN 'dividend' ELSE 'split' END AS kind, amount AS value
        FROM Corporate_Action
    """,
    "raw_chain": """
        SELECT underlying_id, expiration_date, option_type, strike_price AS strike, implied_volatility, CASE WHEN option_id % 4 = 3 THEN NULL ELSE open_interest END AS open_interest
        FROM Option_Contract
    """,
    "pf_spec": """
        SELECT c_custkey AS spec_id, 's' || LPAD(CAST(c_custkey % 10 AS STRING), 5, '0') || ':' || CAST(1 + c_custkey % 50 AS STRING) || ':150.5, SPY :5,BAD,ZZZ:3:1,S00001:-2,:4,S00002:10abc:7,PRM:2:40' || CASE WHEN c_custkey % 3 = 0 THEN ',SPY:8:500' ELSE '' END AS spec
        FROM customer
    """,
    "pf_save_request": """
        SELECT c_custkey AS request_id, CASE c_custkey % 4 WHEN 0 THEN 'u:' || CAST(c_custkey % 10 AS STRING) WHEN 1 THEN 'nobody' ELSE 'u:' || CAST(c_custkey % 10 AS STRING) END AS owner, CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE 'Plan ' || CAST(c_custkey AS STRING) END AS name, CASE WHEN c_custkey % 6 = 0 THEN 'BAD,:1:2' ELSE 'S00001:4:-3,SPY:2:500,ZZZ:1' END AS holdings, CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE 0 END AS portfolio_id
        FROM customer
    """,
    "option_target": """
        SELECT option_id, underlying_id, CASE WHEN option_id % 9 = 8 THEN DATE '2003-01-17' ELSE expiration_date END AS expiration_date, CAST(strike_price + 3.37 AS DECIMAL(12,2)) AS strike, option_type, CAST(0.25 AS DECIMAL(8,4)) AS iv_fallback, 11 AS oi_fallback
        FROM Option_Contract
    """,
    "raw_etf_info": """
        SELECT 'S' || LPAD(CAST(s_suppkey AS STRING), CAST(GREATEST(5, LENGTH(CAST(s_suppkey AS STRING))) AS INT), '0') AS symbol, CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Long ' || s_name END AS long_name, CASE s_suppkey % 4 WHEN 0 THEN 'Short ' || s_name WHEN 1 THEN '' END AS short_name, CASE WHEN s_suppkey % 5 = 0 THEN CAST(0 AS DOUBLE) WHEN s_suppkey % 5 < 3 THEN CAST(s_suppkey AS DOUBLE) / 100000 END AS expense_a, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS DOUBLE) / 50000 END AS expense_b
        FROM supplier
    """,
    "raw_holding": """
        SELECT portfolio_id, CASE WHEN security_id % 8 = 7 THEN 'Q' || CAST(security_id AS STRING) ELSE 'S' || LPAD(CAST(security_id AS STRING), CAST(GREATEST(5, LENGTH(CAST(security_id AS STRING))) AS INT), '0') END AS ticker, shares, average_cost
        FROM Holding
    """,
}


def _mentioned(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [name for name in RELATIONS if name in words]


def with_relations(body: str) -> str:
    """``body`` preceded by the relations it reads, directly or through others.

    ``body`` may start with its own WITH list, which is merged.
    """
    needed: set[str] = set()
    pending = _mentioned(body)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += [m for m in _mentioned(RELATIONS[name]) if m != name]
    ctes = [f"{name} AS ({text.strip()})" for name, text in RELATIONS.items() if name in needed]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rounded(expr: str, digits: int) -> str:
    """Counterpart of ``functions.round_half_away``; adding 0 turns -0.0 into 0.0."""
    value = f"CAST({expr} AS DOUBLE)"
    return f"(ROUND({value} + SIGN({value}) * 1e-9 + {value} * 4e-16, {digits}) + CAST(0 AS DOUBLE))"


def pct(new: str, old: str) -> str:
    """Counterpart of ``functions.pct_change``."""
    return f"(CAST({new} - {old} AS DOUBLE) / NULLIF(CAST({old} AS DOUBLE), 0) * CAST(100 AS DOUBLE))"
