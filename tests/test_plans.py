"""Shapes the physical plans must not have."""

from __future__ import annotations

import re

import pytest

from marketloom.suite import all_cases
from tests.conftest import SMALL

KEYS = ["s2_rolling_vol_universe", "q02_rolling_vol_calendar_universe", "s4_action_impact_universe",
        "s5_return_vs_benchmark_universe", "r1_sector_vs_benchmark", "r2_pe_by_industry", "r3_eps_growth_count_universe",
        "r4_top_volatile", "r5_below_avg_pe", "r6_dividend_yield", "r9_volume_leaders", "q09_eps_growth_strict",
        "q12_dividend_yield", "pf_holdings_universe", "pf_series_universe", "dq_foreign_key", "ing_option_nearest_strike"]


@pytest.fixture
def without_broadcast(spark):
    """Plans as for tables beyond the broadcast threshold."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_product_and_no_single_task_window(spark, without_broadcast, key):
    plan = plan_of(all_cases()[key].run(spark, SMALL)).splitlines()
    assert not [line for line in plan if "CartesianProduct" in line or "NestedLoop" in line]
    for i, line in enumerate(plan):
        # A single partition may only collect the partial rows of a keyless aggregate.
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[]" in plan[i - 1], plan[i - 1]


def test_date_range_and_ticker_reach_the_scan(spark):
    plan = plan_of(all_cases()["s1_close_series"].run(spark, SMALL))
    scan = [line for line in plan.splitlines() if "l_suppkey" in line and "FileScan" in line][0]
    # The ids of a ticker are bounded by subqueries, which are known when the scan starts.
    assert re.search(r"l_suppkey#\d+L >= (ReusedSubquery )?(Subquery|scalar-subquery)", scan), scan
    assert "l_shipdate" in scan.split("PushedFilters")[1]
    read = re.search(r"FileScan parquet \[(.*?)\]", scan).group(1)
    assert "l_quantity" not in read and "l_discount" not in read


def test_top_k_is_taken_per_task(spark):
    assert "TakeOrderedAndProject" in plan_of(all_cases()["r4_top_volatile"].run(spark, SMALL))
    assert "WindowGroupLimit" in plan_of(all_cases()["op_topn_per_key"].run(spark, SMALL))


def test_all_asof_legs_share_one_shuffle_of_prices(spark, without_broadcast):
    plan = plan_of(all_cases()["s4_action_impact_universe"].run(spark, SMALL))
    windows = [line for line in plan.splitlines() if "Window [last(mark" in line]
    assert len(windows) == 2
    between = plan[plan.index(windows[0]):plan.index(windows[1])]
    assert "Exchange" not in between


@pytest.mark.parametrize("key", ["s1_close_series", "q01_daily_return", "s2_rolling_vol", "s4_action_impact", "s5_return_vs_benchmark",
                                 "s6_snapshot_trend", "r1_sector_vs_benchmark", "q07_sector_vs_benchmark", "pf_holdings", "pf_series"])
def test_building_an_analysis_starts_no_job(spark, key):
    group = f"build-{key}"
    spark.sparkContext.setJobGroup(group, key)
    all_cases()[key].run(spark, SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert not jobs


def test_a_session_with_few_partitions_spreads_what_a_task_holds(spark, without_broadcast):
    for key, step in (("s4_action_impact_universe", r"Window \[last\(mark"), ("dq_primary_key", r"keys=\[portfolio_id#\d+L, security_id")):
        plan = plan_of(all_cases()[key].run(spark, SMALL))
        behind = plan[re.search(step, plan).start():]
        assert "24), REPARTITION_BY_NUM" in behind[behind.index("Exchange"):].splitlines()[0]


def test_asof_rows_are_narrow(spark, without_broadcast):
    plan = plan_of(all_cases()["s4_action_impact_universe"].run(spark, SMALL))
    window = [line for line in plan.splitlines() if "Window [last(mark" in line][0]
    assert "is_probe" not in window and "action_date" not in window


@pytest.mark.parametrize("key", ["win_rows_stddev", "win_rows_stddev_bucketed", "s2_rolling_vol_universe", "q02_rolling_vol_calendar_universe"])
def test_a_rolling_deviation_is_evaluated_once(spark, key):
    plan = plan_of(all_cases()[key].run(spark, SMALL))
    assert len(re.findall(r"stddev_(?:samp|pop)\([^()]*\) windowspecdefinition", plan)) == 1


def test_the_basket_is_made_of_combined_ticks(spark):
    plan = plan_of(all_cases()["table_price"].run(spark, SMALL))
    # One shuffle by security and day, and one of a row per day and task.
    assert plan.count("Exchange hashpartitioning(security_id") == 1 and plan.count("Exchange") == 2
