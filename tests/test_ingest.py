from __future__ import annotations

import math

from marketloom.ingest import market as mk
from marketloom.ingest import pipeline, reference
from marketloom.quality import constraints
from tests.market import d, rows


def members(spark, *given):
    return spark.createDataFrame(
        [(i, *g) for i, g in enumerate(given)], "ordinal long, symbol string, security string, sector string, sub_industry string")


def test_constituents_are_cleaned_once_per_symbol(spark):
    raw = members(spark, (" BRK.B ", "First", "Fin", "Ins"), ("BRK-B", "Second", "Fin", "Ins"), ("AAA", None, "Fin", "Ins"),
                  ("ZZZ", "Zed", "Tech", "Soft"))
    assert sorted(rows(reference.clean_constituents(raw))) == [("BRK-B", "First", "Fin", "Ins"), ("ZZZ", "Zed", "Tech", "Soft")]
    assert rows(reference.clean_constituents(raw, max_symbols=1)) == [("BRK-B", "First", "Fin", "Ins")]


def test_an_industry_under_two_sectors_resolves_to_the_later_id(spark):
    clean = reference.clean_constituents(members(
        spark, ("B", "Bee", "Tech", "Mixed"), ("A", "Ay", "Fin", "Mixed"), ("AAPL", "Apple", "Tech", "Soft")))
    sectors = reference.sector_table(clean)
    industries = reference.industry_table(clean, sectors)
    assert sorted(rows(sectors)) == [(1, "Fin"), (2, "Tech")]
    assert sorted(rows(industries)) == [(1, "Mixed", 1), (2, "Mixed", 2), (3, "Soft", 2)]
    listing = reference.listing_tables(clean, industries)
    assert sorted(rows(listing.company)) == [(1, "Ay", 2, "US"), (2, "Apple", 3, "US"), (3, "Bee", 2, "US")]
    assert sorted(rows(listing.security))[1] == (2, "AAPL", 2, "USD", "stock")
    funds = reference.append_funds(listing.security, ["SPY", "QQQ"])
    assert sorted(rows(funds))[3:] == [(4, "SPY", 2, "USD", "etf"), (5, "QQQ", 2, "USD", "etf")]


def test_option_symbols_are_cut_to_twenty(spark):
    data = spark.createDataFrame([("AAPL", d("2025-04-18"), "call", 200.0), ("V", d("2025-04-18"), "put", 7.5)],
                                 "r string, e date, t string, k double")
    got = rows(data.select(reference.option_symbol("r", "e", "t", "k")))
    assert got == [("AAPL20250418C0020000",), ("V20250418P00007500",)]


def test_prices_are_cleaned(spark):
    raw = spark.createDataFrame([
        ("AAA", "2024-01-02", 1.00005, 2.0, 0.5, 1.5, 10.0), ("AAA", "2024-01-03", None, math.nan, 1.0, 1.0, math.nan),
        ("AAA", "2024-01-04", 1.0, 1.0, 1.0, math.nan, 1.0), ("AAA", "2024-01-05", 1.0, 1.0, 1.0, None, 1.0),
        ("XXX", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0)],
        "symbol string, trade_date string, open double, high double, low double, close double, volume double")
    known = spark.createDataFrame([(1, "AAA")], "security_id long, ticker string")
    got = [(r[0], r[1], *[None if v is None else float(v) for v in r[2:6]], r[6]) for r in rows(mk.clean_prices(raw, known))]
    assert sorted(got) == [(1, d("2024-01-02"), 1.0001, 2.0, 0.5, 1.5, 10), (1, d("2024-01-03"), None, None, 1.0, 1.0, 0)]


def test_wide_prices_become_rows(spark):
    wide = spark.createDataFrame([(d("2024-01-02"), 1.0, 5, None, None)],
                                 "trade_date date, `A_close` double, `A_volume` int, `B.X_close` double, `B.X_volume` int")
    assert rows(mk.long_prices(wide, ["A", "B.X"], ["close", "volume"])) == [("A", d("2024-01-02"), 1.0, 5)]


def test_fund_metadata_falls_back(spark):
    funds = spark.createDataFrame([(s, f"{s} fund", 0.5) for s in "ABCD"], "symbol string, name_fallback string, expense_fallback double")
    info = spark.createDataFrame(
        [("A", "Long", "Short", 0.001, 0.9), ("B", "", "Short", 0.0, 0.002), ("C", None, "", None, math.nan)],
        "symbol string, long_name string, short_name string, expense_a double, expense_b double")
    assert sorted(rows(mk.fund_metadata(funds, info))) == [
        ("A", "Long", 0.1), ("B", "Short", 0.2), ("C", "C fund", 0.5), ("D", "D fund", 0.5)]


TARGET = "underlying_id long, expiration_date date, strike double, option_type string, iv_fallback double, oi_fallback int"
CHAIN = "underlying_id long, expiration_date date, option_type string, strike double, implied_volatility double, open_interest int"


def test_nearest_strike_prefers_the_lower_and_falls_back(spark):
    e = d("2025-04-18")
    targets = spark.createDataFrame([(1, e, 100.0, "call", 0.9, 9), (1, e, 101.0, "put", 0.9, 9), (2, e, 1.0, "call", 0.9, 9),
                                     (1, e, 500.0, "call", 0.9, 9), (1, e, 1.0, "call", 0.9, 9)], TARGET)
    chain = spark.createDataFrame([(1, e, "call", 95.0, 0.1, 1), (1, e, "call", 105.0, 0.2, 2), (1, e, "call", 120.0, None, 3),
                                   (1, e, "put", 90.0, 0.3, None)], CHAIN)
    got = mk.nearest_strikes(targets, chain).select("underlying_id", "option_type", "strike", "implied_volatility", "open_interest")
    assert sorted(rows(got)) == [
        (1, "call", 1.0, 0.1, 1), (1, "call", 100.0, 0.1, 1), (1, "call", 500.0, 0.9, 3), (1, "put", 101.0, 0.3, 0),
        (2, "call", 1.0, 0.9, 9)]


def test_modes_dates_and_scope(spark):
    days = spark.createDataFrame([(d("2024-06-02"),), (d("2024-06-03"),)], "day date")
    assert rows(days.select(mk.run_mode("day"))) == [("full",), ("daily",)]
    one = spark.range(1)

    def dates(*args, **kw):
        return one.select(*mk.date_range(*args, **kw)).first()[:]

    assert dates(None, None, "2024-02-29", env={}) == (d("2021-02-28"), d("2024-02-29"))
    assert dates("2020-01-01", None, "2024-02-29", env={"PRICE_START": "2019-01-01", "PRICE_END": "2023-01-01"}) == (
        d("2020-01-01"), d("2023-01-01"))
    universe = spark.createDataFrame([("AAPL",), ("ZZZ",)], "symbol string")
    assert rows(mk.fundamentals_scope(universe, "daily")) == [("AAPL",)]
    assert len(rows(mk.fundamentals_scope(universe, "full"))) == 2


def test_actions_are_classified_and_numbered(spark):
    raw = spark.createDataFrame([
        ("B", d("2024-03-01"), "split", 4.0), ("B", d("2024-05-01"), "dividend", 0.1234567), ("A", d("2024-02-01"), "split", 0.1),
        ("A", d("2023-12-31"), "dividend", 1.0), ("C", d("2024-02-01"), "dividend", 1.0)],
        "symbol string, action_date date, kind string, value double")
    ids = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "security_id long, ticker string")
    scope = spark.createDataFrame([("A",), ("B",)], "symbol string")
    got = [(*r[:4], float(r[4])) for r in rows(mk.classify_actions(raw, scope, ids, "2024-01-01", "2024-12-31"))]
    assert sorted(got) == [(1, 1, d("2024-02-01"), "reverse_split", 0.1), (2, 2, d("2024-05-01"), "dividend", 0.123457),
                           (3, 2, d("2024-03-01"), "split", 4.0)]


def test_the_whole_pipeline_builds_valid_tables(spark):
    e = d("2025-04-18")
    raw = {
        "constituents": members(spark, ("AAPL", "Apple", "Tech", "Hard"), ("MSFT", "Micro", "Tech", "Soft"), ("ZZZ", "Zed", "Fin", "Ins")),
        "prices": spark.createDataFrame(
            [(s, d("2024-01-02"), 1.0, 1.0, 1.0, 1.0, 5.0) for s in ("AAPL", "SPY", "NONE")] + [("AAPL", d("2019-01-02"), 1.0, 1.0, 1.0, 1.0, 5.0)],
            "symbol string, trade_date date, open double, high double, low double, close double, volume double"),
        "fund_info": spark.createDataFrame([("SPY", "Spider", "", 0.000945, None)],
                                           "symbol string, long_name string, short_name string, expense_a double, expense_b double"),
        "chain": spark.createDataFrame([(1, e, "call", 205.0, 0.3, 7)], CHAIN),
        "info": spark.createDataFrame([("AAPL", 5, 30.123, 0.0, None)],
                                      "symbol string, market_cap long, trailing_pe double, trailing_eps double, beta double"),
        "actions": spark.createDataFrame([("AAPL", d("2024-02-01"), "dividend", 0.25)],
                                         "symbol string, action_date date, kind string, value double"),
    }
    built = pipeline.build_tables(raw, mode="daily", today="2024-06-01")
    assert rows(constraints.all_violations(built)) == []
    counts = {name: rows_.count() for name, rows_ in built.items()}
    assert counts["Security"] == 3 + 5 + 5 and counts["Price"] == 2 and counts["Holding"] == 7
    snaps = rows(built["Financial_Snapshot"])
    assert [(r[0], r[1], r[3], float(r[4]), r[5]) for r in snaps if r[3]] == [(1, 1, 5, 30.12, None)] and len(snaps) == 2
    option = [r for r in rows(built["Option_Contract"]) if r[0] == 1][0]
    assert (option[1], float(option[5]), option[6]) == (9, 0.3, 7)


def test_a_week_of_runs_over_landed_files(spark, folder):
    from marketloom.sources import store

    def delivery(*days):
        prices = [(s, d(day), 1.0, 1.0, 1.0, close, 5.0) for day, close in days for s in ("AAPL", "SPY")]
        return {
            "constituents": members(spark, (" AAPL", "Apple", "Tech", "Hard, ware"), ("BRK.B", "Berk", "Fin", "Ins"), ("AAPL", "Later", "Fin", "Ins")),
            "prices": spark.createDataFrame(prices, pipeline.LAYOUTS["prices"]),
            "fund_info": spark.createDataFrame([("SPY", "Spider", None, 0.000945, None)], pipeline.LAYOUTS["fund_info"]),
            "chain": spark.createDataFrame([], pipeline.LAYOUTS["chain"]),
            "info": spark.createDataFrame([("AAPL", 5, 30.123, 0.0, None)], pipeline.LAYOUTS["info"]),
            "actions": spark.createDataFrame([("AAPL", d("2024-02-01"), "dividend", 0.25)], pipeline.LAYOUTS["actions"]),
        }

    def closes():
        return sorted((str(r.trade_date), float(r.close)) for r in store.open_store(spark, f"{folder}/store")["Price"].collect())

    # A Saturday with nothing loaded yet, the Sunday, and a Monday.
    for n, (today, days) in enumerate([
        ("2024-06-01", [("2023-12-29", 1.0), ("2024-05-31", 2.0)]), ("2024-06-02", [("2023-12-29", 1.0), ("2024-05-31", 3.0)]), ("2024-06-03", [("2024-06-03", 4.0)]),
    ]):
        pipeline.land(delivery(*days), f"{folder}/{n}")
        done = pipeline.refresh(spark, f"{folder}/{n}", f"{folder}/store", today)
        assert done == [1, 2, [2024]][n]
    assert closes() == sorted([("2023-12-29", 1.0), ("2024-05-31", 3.0), ("2024-06-03", 4.0)] * 2)
    saved = store.open_store(spark, f"{folder}/store")
    assert [r.company_name for r in saved["Company"].orderBy("company_id").collect()] == ["Apple", "Berk"]
    assert [r.industry_name for r in saved["Industry"].orderBy("industry_id").collect()] == ["Hard, ware", "Ins"]


def test_a_load_that_breaks_a_rule_is_refused(spark, folder):
    import dataclasses

    import pytest

    from marketloom.sources import store

    raw = {name: spark.createDataFrame([], layout) for name, layout in pipeline.LAYOUTS.items()}
    raw["constituents"] = members(spark, ("AAPL", "Apple", "Tech", "Hard"))
    pipeline.land(raw, f"{folder}/in")
    curated = pipeline.Curated.standard(spark)
    wrong = dataclasses.replace(curated, holdings=curated.holdings.withColumn("shares", -curated.holdings.shares))
    with pytest.raises(ValueError, match="rejected"):
        pipeline.load(spark, f"{folder}/in", f"{folder}/store", wrong, today="2024-06-01")
    assert store.current_version(spark, f"{folder}/store") == 0


def test_a_load_derives_each_step_once(spark, folder):
    from marketloom.sources import store

    raw = {name: spark.createDataFrame([], layout) for name, layout in pipeline.LAYOUTS.items()}
    raw["constituents"] = members(spark, ("AAPL", "Apple", "Tech", "Hard"), ("MSFT", "Micro", "Tech", "Soft"), ("ZZZ", "Zed", "Fin", "Ins"))
    built = pipeline.build_tables(raw, mode="full", today="2024-06-01", keep=store.stage(spark, folder))
    for name in ("Industry", "Company", "Security", "Stock", "Option_Contract", "Holding"):
        plan = built[name]._jdf.queryExecution().executedPlan().toString()
        # The list of members, with its row_number, was in the plan of each, up to dozens of times.
        assert "raw_constituents" not in plan and "WindowGroupLimit" not in plan and plan.count("Exchange ") < 12, name
    assert sorted(rows(built["Company"])) == [(1, "Apple", 1, "US"), (2, "Micro", 3, "US"), (3, "Zed", 2, "US")]
    assert built["Security"].count() == 3 + 5 + 5


def test_a_table_is_checked_by_a_plan_of_its_own(spark, folder):
    import pytest

    from marketloom.sources import store
    from tests.test_quality import full

    t = dict(full(spark))
    for check in constraints.EACH_TABLE:
        assert check(t).first() is None
        assert check(t)._jdf.queryExecution().executedPlan().toString().count("Exchange ") < 24
    t["Stock"] = t["Stock"].unionByName(t["Stock"])
    with pytest.raises(ValueError, match="primary key"):
        store.full_refresh(spark, t, folder, check=constraints.EACH_TABLE)
    assert store.current_version(spark, folder) == 0


def test_the_symbols_of_actions_stay_out_of_the_driver(spark):
    from marketloom.suite import all_cases
    from tests.conftest import SMALL

    plan = all_cases()["ing_action_classify"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    # They were broadcast twice in each pass; the sizes of the id ranges still may be.
    by_symbol = [line for line in joins if "__range" not in line]
    assert len(by_symbol) >= 4 and all("ShuffledHashJoin" in line for line in by_symbol), by_symbol
