"""Results stay whole when one key owns a third of the rows."""

from __future__ import annotations

import shutil
import tempfile

import duckdb
import pytest

from marketloom.suite import all_cases
from tests.conftest import SMALL, connect
from tools.check_oracle import compare

KEYS = ["table_price", "table_corporate_action", "table_holding", "s2_rolling_vol_universe", "s4_action_impact_universe",
        "r1_sector_vs_benchmark", "r3_eps_growth_count_universe", "r6_dividend_yield", "pf_holdings_universe",
        "pf_series_universe", "dq_foreign_key", "ing_action_classify"]


@pytest.fixture(scope="module")
def skewed():
    """Copies of the tables where security 3, one day of it and portfolio 3 are hot."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name in ("region", "nation", "customer", "supplier", "part"):
        shutil.copy(f"{SMALL}/{name}.parquet", folder)
    con = duckdb.connect()
    con.execute(f"""COPY (
        SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey,
                          CASE WHEN l_partkey % 12 = 0 THEN TIMESTAMP '1997-06-02' ELSE l_shipdate END AS l_shipdate)
        FROM '{SMALL}/lineitem.parquet'
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY l_suppkey) = 1
        ) TO '{folder}/lineitem.parquet'""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey)
                          FROM '{SMALL}/orders.parquet') TO '{folder}/orders.parquet'""")
    return folder


@pytest.mark.parametrize("name", KEYS)
def test_hot_keys(spark, skewed, name):
    case = all_cases()[name]
    assert compare(case.run(spark, skewed), connect(skewed), case.sql) == ""
