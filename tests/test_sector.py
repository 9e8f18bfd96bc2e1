from __future__ import annotations

from marketloom.plans import catalog, sector
from tests.market import market, prices, rows


def snaps(*given):
    return [(i, *g) for i, g in enumerate(given, 1)]


def test_latest_snapshot_comes_before_the_measure_filter(spark):
    t = market(spark, Financial_Snapshot=snaps(
        (1, "2024-03-31", 10, 20.0), (1, "2024-06-30", 10, None), (2, "2024-06-30", 10, -3.0), (3, "2024-06-30", 10, 8.0)))
    # Alpha's older P/E must not stand in for the missing latest one.
    assert rows(sector.pe_by_industry(t, "technology")) == []
    assert rows(sector.pe_by_industry_min_cap(t, "Technology")) == [("Chips", 1, -3.0)]
    assert rows(sector.pe_by_industry(t, "Energy")) == [("Oil", 8.0, 1)]


def test_growth_count_treats_missing_eps_as_no_rise(spark):
    eps = [1, 2, None, 3, 4, 5, 6]
    t = market(spark, Financial_Snapshot=snaps(*[
        (1, f"2023-{m:02d}-28", None, None, e) for m, e in enumerate(eps, 1)]))
    # Rows with a previous EPS: 2>1, None, 4>3, 5>4, 6>5 (3 follows a gap and is left out).
    assert rows(sector.eps_growth_count(t, min_q=3)) == [("Alpha", "Technology", 3)]
    assert rows(sector.eps_growth_count(t, min_q=4)) == []
    assert rows(catalog.run("r3", t, min_q=3)) == [("Alpha", "Technology", 3)]
    assert rows(sector.eps_growth_count(t, sector="Energy", min_q=1)) == []


def test_strict_growth_needs_five_snapshots_and_no_stall(spark):
    def run(*eps):
        t = market(spark, Financial_Snapshot=snaps(*[
            (1, f"2023-{m:02d}-28", None, None, e) for m, e in enumerate(eps, 1)]))
        return rows(sector.eps_growth_strict(t, "Technology"))

    assert run(1, 2, 3, 4, 5) == [("Alpha", "AAA")]
    assert run(2, 3, 4, 5) == []
    assert run(1, 2, 3, 3, 4) == []
    # A gap violates nothing on either side, and stalls before the last four do not count.
    assert run(9, 8, 7, None, 5, 6, 7) == [("Alpha", "AAA")]


def test_volatility_ties_are_ordered_by_ticker_and_capped_at_ten(spark):
    ids = list(range(1, 13))
    securities = [(i, f"T{i:02d}", 1, "USD", "stock") for i in ids]
    companies = [(i, f"C{i:02d}", 1, "US") for i in ids]
    series = [(i, day, close) for i in ids for day, close in (("2024-01-02", 100), ("2024-01-03", 110), ("2024-01-04", 99))]
    t = market(spark, Security=securities, Company=companies, Stock=[(i, i) for i in ids], Price=prices(spark, *series))
    got = rows(sector.top_volatile(t, "Technology", "2024-01-01", "2024-12-31"))
    assert [r[0] for r in got] == [f"T{i:02d}" for i in ids[:10]]
    got = rows(sector.top_price_stddev(t, "Technology", "2024-01-01", "2024-12-31"))
    assert [r[0] for r in got] == [f"T{i:02d}" for i in ids[:10]] and got[0][3] == 3


def test_sector_returns_need_a_benchmark(spark):
    own = [(1, "2024-01-02", 10), (1, "2024-12-30", 20), (2, "2024-01-02", 10), (2, "2024-12-30", 10)]
    t = market(spark, Price=prices(spark, *own))
    assert rows(sector.sector_vs_benchmark(t, "2024-01-01", "2024-12-31")) == []
    t = market(spark, Price=prices(spark, *own, (4, "2024-01-02", 100), (4, "2024-12-30", 110)))
    assert rows(sector.sector_vs_benchmark(t, "2024-01-01", "2024-12-31")) == [("Technology", 50.0, 10.0, 40.0)]
    assert rows(sector.sector_vs_benchmark_counted(t, "2024-01-01", "2024-12-31")) == [("Technology", 2, 50.0, 10.0)]


def test_dividend_yield_window_and_zero_close(spark):
    actions = [(1, 1, "2023-02-28", "dividend", 1), (2, 1, "2023-02-27", "dividend", 5), (3, 1, "2024-06-01", "dividend", 1),
               (4, 1, "2024-01-01", "split", 2), (5, 2, "2024-01-01", "dividend", 1), (6, 3, "2024-01-01", "dividend", 0)]
    series = prices(spark, (1, "2024-01-02", 40), (1, "2024-02-01", 50), (2, "2024-01-02", 0), (3, "2024-01-02", 10))
    t = market(spark, Corporate_Action=actions, Price=series)
    # One year before 29 February is the 28th; later actions have no upper bound.
    assert rows(sector.dividend_yield(t, "Technology", "2024-02-29")) == [
        ("Alpha", "AAA", 4.0, 2.0, 50.0), ("Beta", "BBB", None, 1.0, 0.0)]
    assert rows(sector.dividend_yield(t, "Energy", "2024-02-29")) == []


def test_tiers_at_their_bounds(spark):
    t = market(spark, Financial_Snapshot=snaps((1, "2024-03-31", 200_000_000_000), (2, "2024-03-31", 299_999_999)))
    assert [(r[1], r[4]) for r in rows(sector.cap_tiers(t, "Technology"))] == [
        ("AAA", "Mega Cap (>=200B)"), ("BBB", "Small Cap (<2B)")]
    assert rows(sector.cap_tier_distribution(t, "Technology")) == [
        ("Mega Cap (>200B)", 1, 200.0), ("Micro Cap (<300M)", 1, 0.3)]


def test_share_below_the_industry_mean(spark):
    stocks = [(1, 1), (2, 1), (3, 2)]
    companies = [(1, "Alpha", 1, "US"), (2, "Beta", 1, "US")]
    t = market(spark, Stock=stocks, Company=companies, Financial_Snapshot=snaps(
        (1, "2024-03-31", None, 10), (2, "2024-03-31", None, 12), (3, "2024-03-31", None, 20)))
    assert rows(sector.below_average_pe(t)) == [("Software", 14.0, 3, 66.7)]
    assert rows(sector.below_average_pe_distinct(t)) == [("Software", 2, 2, 100.0)]


def test_volume_leaders_and_names(spark):
    series = prices(spark, (1, "2024-01-02", 10, 5), (1, "2024-01-03", 20, 6), (2, "2024-01-02", 10, 9))
    t = market(spark, Price=series)
    assert rows(sector.volume_leaders(t, "Technology", "2024-01-01", "2024-12-31")) == [
        ("BBB", "Beta", "Chips", 9.0, 10.0), ("AAA", "Alpha", "Software", 6.0, 15.0)]
    assert rows(sector.tickers(t)) == [
        ("AAA", "Alpha", "stock"), ("BBB", "Beta", "stock"), ("CCC", "Gamma", "stock"), ("SPY", "Basket", "etf")]


def test_growth_of_a_company_with_many_stocks_equals_one_window(spark, monkeypatch):
    import random

    from marketloom.operators import stretches

    rng = random.Random(3)
    stocks = [(i, 1 if i % 3 else 2) for i in range(1, 16)]
    companies = [(1, "Many", 1, "US"), (2, "Some", 2, "US")]
    given = snaps(*[(i, f"2023-{m:02d}-28", None, None, rng.choice([None, 1, 2, 3, 4]))
                    for i, _ in stocks for m in range(1, 9)])
    t = market(spark, Stock=stocks, Company=companies, Financial_Snapshot=given)
    plain = sorted(rows(sector.eps_growth_count(t, min_q=1)))
    monkeypatch.setattr(stretches, "STRETCH_ROWS", 5)
    assert sorted(rows(sector.eps_growth_count(t, min_q=1))) == plain and len(plain) == 2


def test_stretches_equal_one_window_per_series(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from marketloom.operators.stretches import over_stretches

    data = spark.range(500).selectExpr("id % 3 AS k", "id AS x", "(id * 7919) % 101 AS v")

    def compute(df, window):
        return df.withColumn("prev", F.lag("v").over(window)).withColumn("s", F.sum("v").over(window.rowsBetween(-3, 0)))

    whole = compute(data, Window.partitionBy("k").orderBy("x"))
    for size in (1, 4, 50, 1000):
        got = over_stretches(data, ["k"], ["x"], 3, compute, stretch_rows=size)
        assert sorted(rows(got.select(*whole.columns))) == sorted(rows(whole)), size
