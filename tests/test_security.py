from __future__ import annotations

import pytest

from marketloom.operators import timeseries as ts
from marketloom.plans import catalog, security
from tests.market import d, market, prices, rows, table


def test_zero_previous_close_gives_null(spark):
    t = market(spark, Price=prices(spark, (1, "2024-01-02", 0), (1, "2024-01-03", 5)))
    got = rows(security.daily_return(t, "AAA", "2024-01-01", "2024-12-31"))
    assert got == [(d("2024-01-03"), 5.0, None)]


def test_first_day_is_dropped_but_predecessor_may_precede_the_range(spark):
    t = market(spark, Price=prices(spark, (1, "2023-12-29", 100), (1, "2024-01-02", 110), (1, "2024-01-03", 99)))
    got = rows(security.daily_return(t, "aaa ", "2024-01-01", "2024-12-31"))
    assert got == [(d("2024-01-02"), 110.0, 10.0), (d("2024-01-03"), 99.0, -10.0)]


def test_one_return_sample_is_null_population_is_zero(spark):
    t = market(spark, Price=prices(spark, (1, "2024-01-02", 100), (1, "2024-01-03", 110)))
    assert rows(security.rolling_volatility(t, "AAA", "2024-01-01", "2024-12-31")) == [(d("2024-01-03"), None)]
    got = rows(security.rolling_volatility_calendar(t, "AAA", "2024-01-01", "2024-12-31"))
    assert got == [(d("2024-01-02"), None), (d("2024-01-03"), 0.0)]


def test_rolling_rows_ignore_prices_outside_the_range(spark):
    series = prices(spark, (1, "2023-12-29", 50), (1, "2024-01-02", 100), (1, "2024-01-03", 110), (1, "2024-01-04", 99))
    got = rows(security.rolling_volatility(market(spark, Price=series), "AAA", "2024-01-01", "2024-12-31"))
    expected = (0.1 - -0.1) / 2**0.5 * 252**0.5 * 100
    assert got == [(d("2024-01-03"), None), (d("2024-01-04"), round(expected, 2))]


def test_same_ticker_on_two_exchanges_stays_apart(spark):
    twins = [(1, "AAA", 1, "USD", "stock"), (2, "AAA", 2, "USD", "stock")]
    series = prices(spark, (1, "2024-01-02", 10), (1, "2024-01-03", 20), (2, "2024-01-02", 100), (2, "2024-01-03", 90))
    t = market(spark, Security=twins, Price=series)
    got = sorted(rows(security.daily_return(t, "AAA", "2024-01-01", "2024-12-31")))
    assert got == [(d("2024-01-03"), 20.0, 100.0), (d("2024-01-03"), 90.0, -10.0)]


def test_no_benchmark_gives_no_rows(spark):
    series = prices(spark, (1, "2024-01-02", 10), (1, "2024-06-03", 20))
    assert rows(security.return_vs_benchmark(market(spark, Price=series), "AAA", "2024-01-01", "2024-12-31")) == []


def test_each_bound_of_a_return_acts_alone(spark):
    series = prices(spark, (1, "2024-01-02", 10), (1, "2024-12-01", 20), (4, "2024-01-02", 100), (4, "2024-12-30", 110))
    t = market(spark, Price=series)
    # The range lies in a gap: the first close on or after it follows the last one before its end.
    assert rows(security.return_vs_benchmark(t, "AAA", "2024-03-01", "2024-03-31")) == [
        (-50.0, round((100 - 110) / 110 * 100, 2), -40.91)
    ]
    assert rows(security.return_vs_benchmark(t, "AAA", "2024-12-15", "2024-12-31")) == []
    assert rows(security.return_vs_benchmark_named(t, "AAA", "2024-01-01", "2024-12-31")) == [("AAA", 100.0, 10.0, 90.0)]


def test_two_benchmark_listings_give_a_row_each(spark):
    securities = [(1, "AAA", 1, "USD", "stock"), (4, "SPY", 1, "USD", "etf"), (6, "SPY", 2, "USD", "etf")]
    series = prices(spark, (1, "2024-01-02", 10), (1, "2024-12-01", 20), (4, "2024-01-02", 100), (4, "2024-12-30", 110),
                    (6, "2024-01-02", 100), (6, "2024-12-30", 120))
    t = market(spark, Security=securities, Price=series)
    got = sorted(rows(security.return_vs_benchmark(t, "AAA", "2024-01-01", "2024-12-31")))
    assert got == [(100.0, 10.0, 90.0), (100.0, 20.0, 80.0)]


def test_action_prices_on_bounds_and_before_the_first_price(spark):
    series = prices(spark, (1, "2024-03-01", 100), (1, "2024-03-08", 110), (1, "2024-03-15", 121))
    actions = [(1, 1, "2024-03-08", "dividend", 0.5), (2, 1, "2024-01-01", "split", 2), (3, 1, "2024-03-20", "split", 2)]
    t = market(spark, Price=series, Corporate_Action=actions)
    assert rows(security.action_impact(t, "AAA")) == [
        (d("2024-03-20"), "split", 2.0, 121.0, 110.0, None, 10.0, None),
        (d("2024-03-08"), "dividend", 0.5, 110.0, 100.0, 121.0, 10.0, 10.0),
        (d("2024-01-01"), "split", 2.0, None, None, 100.0, None, None),
    ]
    assert rows(security.action_impact_span(t, "AAA"))[1] == (
        "dividend", d("2024-03-08"), 0.5, 100.0, 110.0, 121.0, 21.0
    )


def test_asof_join_equals_brute_force(spark):
    import random

    rng = random.Random(7)
    marks = {(k, day): day * 10 + k for k in range(3) for day in rng.sample(range(60), 12)}
    probes = [(k, rng.randrange(70)) for k in range(4) for _ in range(25)]
    right = spark.createDataFrame([(k, x, v) for (k, x), v in marks.items()], "k int, x int, v int")
    left = spark.createDataFrame([(i, k, x) for i, (k, x) in enumerate(probes)], "i int, k int, x int")
    legs = [ts.Leg("under"), ts.Leg("over", "forward")]
    got = ts.join_asof(left, right, legs, by=["k"], left_on="x", right_on="x", value="v")

    def nearest(k, x):
        under = [p for (g, p) in marks if g == k and p <= x]
        over = [p for (g, p) in marks if g == k and p >= x]
        return (marks[(k, max(under))] if under else None, marks[(k, min(over))] if over else None)

    expected = sorted((i, *nearest(k, x)) for i, (k, x) in enumerate(probes))
    assert sorted(rows(got.select("i", "under", "over"))) == expected


def test_option_prefix_takes_wildcards_and_exact_ticker_does_not(spark):
    options = [(1, 5, "2025-04-18", 200, "call", 0.3, 10), (2, 5, "2025-04-18", 210, "call", 0.4, 5)]
    t = market(spark, Option_Contract=options)
    assert rows(security.iv_term_structure(t, "aaa")) == [(d("2025-04-18"), "call", 35.0, 15, 2)]
    assert rows(security.iv_term_structure(t, "_AA")) == [(d("2025-04-18"), "call", 35.0, 15, 2)]
    assert rows(security.iv_active(t, "AAA", "2025-01-01")) == []
    full = "AAA250418C00200000"
    assert rows(security.iv_active(t, full, "2025-04-18")) == [(d("2025-04-18"), "call", 2, 0.35, 0.3, 0.4)]
    assert rows(security.iv_active(t, full, "2025-04-19")) == []


def test_snapshot_trend_keeps_missing_measures(spark):
    t = market(spark, Financial_Snapshot=[(1, 1, "2024-03-31", 3_761_492_983_808, 32.35, 6.43, None)])
    assert rows(security.snapshot_trend(t, "AAA")) == [(d("2024-03-31"), 32.35, 6.43, None, 3761.49)]


def test_rows_of_keys(spark):
    from marketloom.operators import keys

    data = spark.range(10).withColumnRenamed("id", "security_id")
    wanted = spark.createDataFrame([(1,), (3,), (3,)], "security_id long")
    assert sorted(rows(keys.rows_of(data, wanted))) == [(1,), (3,)]
    assert rows(keys.rows_of(data, wanted.limit(0))) == []


@pytest.mark.parametrize("value", [5e11, 1e12, 1e13, -1e13])
def test_rounding_leaves_large_values_alone(spark, value):
    from pyspark.sql import functions as F

    from marketloom.functions.scalar import round_half_away

    got = spark.range(1).select(round_half_away(F.lit(value), 2), round_half_away(F.lit(2.345), 2), round_half_away(F.lit(-1.005), 2)).first()
    assert tuple(got) == (value, 2.35, -1.01)


def test_catalog_defaults_and_unknown_names(spark):
    t = market(spark, Price=prices(spark, (1, "2024-01-02", 10), (1, "2024-01-03", 11)))
    got = rows(catalog.run("s1", t, ticker=" aaa", end="2024-01-02", unused=1))
    assert got == [(d("2024-01-02"), 10.0)]
    with pytest.raises(ValueError, match="unknown query: s9"):
        catalog.run("s9", t)
    assert set(rows(catalog.run("sectors", t))) == {("Energy",), ("Technology",)}


def test_as_of_leap_day(spark):
    from marketloom.functions import year_before

    assert spark.range(1).select(year_before("2024-02-29"), year_before("2024-02-29", 3)).first()[:] == (
        d("2023-02-28"), d("2021-02-28")
    )
    assert table(spark, "Sector", [(1, "x")]).count() == 1
