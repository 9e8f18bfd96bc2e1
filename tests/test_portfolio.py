from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.plans import catalog, portfolio
from tests.market import d, market, prices, rows


def parsed(spark, spec):
    specs = spark.createDataFrame([(1, spec)], "spec_id long, spec string")
    got = portfolio.parse_specs(specs).orderBy("position").select("ticker", "shares", "cost")
    return rows(got)


def test_last_entry_counts_at_the_first_position(spark):
    assert parsed(spark, "aapl:10:150, MSFT :5:300,AAPL:7") == [("AAPL", 7.0, 0.0), ("MSFT", 5.0, 300.0)]


def test_entries_that_are_skipped(spark):
    assert parsed(spark, "BAD,:4:1, :4,A:0:1,B:-2:1,C:x:1,,D:1") == [("D", 1.0, 0.0)]
    assert parsed(spark, "") == []


def test_leading_numbers(spark):
    assert parsed(spark, "A:10abc:7x,B: 2.5:.5,C:1e2:-3,D:+4:abc,E:.:1") == [
        ("A", 10.0, 7.0), ("B", 2.5, 0.5), ("C", 100.0, -3.0), ("D", 4.0, 0.0)]


def test_a_long_spec_is_read_whole(spark):
    spec = ",".join(f"T{i}:{i + 1}:2" for i in range(3000))
    got = parsed(spark, spec)
    assert len(got) == 3000 and got[-1] == ("T2999", 3000.0, 2.0)


def test_lowest_id_stands_for_a_shared_ticker(spark):
    twins = [(1, "AAA", 1, "USD", "stock"), (2, "aaa", 2, "USD", "etf")]
    t = market(spark, Security=twins, Price=prices(spark, (1, "2024-01-02", 10), (2, "2024-01-02", 99)))
    got = rows(portfolio.reference(t).select("ticker", "security_id", "latest_close"))
    assert got == [("AAA", 1, 10.0)]


def test_valued_holdings_and_their_gaps(spark):
    actions = [(1, 1, "2024-01-10", "dividend", 0.25)]
    t = market(spark, Price=prices(spark, (1, "2024-01-02", 10), (1, "2024-01-03", 12)), Corporate_Action=actions)
    got = rows(catalog.run("pf_holdings", t, holdings="AAA:10:5,SPY:2:100,XXX:1:3,AAA250418C00200000:1", as_of="2024-02-01"))
    assert got == [
        ("AAA", "Alpha", "Technology", 10.0, 5.0, 12.0, 120.0, 50.0, 70.0, 140.0, 2.5),
        ("SPY", "ETF", "ETF / Fund", 2.0, 100.0, None, None, 200.0, None, None, 0.0),
        ("XXX", None, "Unknown ticker", 1.0, 3.0, None, None, 3.0, None, None, 0.0),
        ("AAA250418C00200000", None, "Other", 1.0, 0.0, None, None, 0.0, None, None, 0.0),
    ]
    saved = rows(catalog.run("pf_holdings", t, pid=1, holdings="SPY:1", as_of="2024-02-01"))
    assert [r[:4] for r in saved] == [("AAA", "Alpha", "Technology", 10.0)]
    assert rows(catalog.run("pf_holdings", t)) == []


def test_saved_holdings_can_be_limited_to_an_owner(spark):
    t = market(spark)
    assert rows(portfolio.saved_holdings(t, 2, owner="u:me").select("ticker")) == [("SPY",)]
    assert rows(portfolio.saved_holdings(t, 2, owner="u:you")) == []
    assert rows(portfolio.saved_holdings(t, 1, owner="u:you").select("ticker")) == [("AAA",)]


def test_series_adds_nothing_for_a_missing_price(spark):
    series = prices(spark, (1, "2024-01-02", 10), (1, "2024-01-03", 11), (4, "2024-01-02", 100), (2, "2024-01-04", 1))
    t = market(spark, Price=series)
    got = rows(catalog.run("pf_series", t, holdings="AAA:2:1,SPY:1:1,XXX:5", start="2024-01-01", end="2024-12-31"))
    assert got == [(d("2024-01-02"), 120.0), (d("2024-01-03"), 22.0)]
    assert rows(catalog.run("pf_series", t, holdings="", start="2024-01-01")) == []


def test_list_shows_samples_and_own(spark):
    t = market(spark)
    assert rows(portfolio.list_portfolios(t, " u:me ")) == [(1, "Sample", "Alice", 1, 1), (2, "Mine", "u:me", 0, 1)]
    assert [r[0] for r in rows(portfolio.list_portfolios(t))] == [1]


REQUEST = "request_id long, owner string, name string, holdings string, portfolio_id long"


def test_save_creates_updates_and_rejects(spark):
    requests = spark.createDataFrame([
        (1, " u:me ", " ", "AAA:4:-3,XXX:1,SPY:0.00001:1", 0),
        (2, "u:me", "First", "BBB:1:1", 2),
        (3, "u:me", "Second", "CCC:2:2", 2),
        (4, "u:me", "Stolen", "AAA:1", 3),
        (5, "U:me", "Case", "AAA:1", 0),
        (6, "u:me", "Empty", "BAD", 0),
        (7, "u:new", "Only unknown", "XXX:1", 0),
        (8, None, None, None, None),
        (9, "u:me", "Gone", "AAA:1", 77),
    ], REQUEST)
    saved = portfolio.save_portfolios(market(spark), requests)
    assert sorted(rows(saved.report)) == [(1, 4, 1), (2, 2, 1), (3, 2, 1), (7, 5, 0)]
    assert sorted(rows(saved.portfolio)) == [
        (1, "Sample", "Alice"), (2, "Second", "u:me"), (3, "Theirs", "u:you"), (4, "My Portfolio", "u:me"),
        (5, "Only unknown", "u:new")]
    assert sorted((r[0], r[1], float(r[2]), float(r[3])) for r in rows(saved.holding)) == [
        (1, 1, 10.0, 5.0), (2, 3, 2.0, 2.0), (4, 1, 4.0, 0.0)]
    assert sorted(rows(portfolio.save_errors(market(spark), requests))) == [
        (4, "not your portfolio"), (5, "invalid owner"), (6, "no valid holdings"), (8, "invalid owner"),
        (9, "not your portfolio")]


def test_delete_cascades_and_checks_the_owner(spark):
    requests = spark.createDataFrame(
        [(1, "u:me", 2), (2, "u:me", 2), (3, "u:me", 3), (4, "Alice", 1), (5, "u:me", 0)],
        "request_id long, owner string, portfolio_id long")
    done = portfolio.delete_portfolios(market(spark), requests)
    assert sorted(rows(done.report)) == [
        (1, 1, None), (2, 0, None), (3, 0, None), (4, None, "bad request"), (5, None, "bad request")]
    assert [r[0] for r in sorted(rows(done.portfolio))] == [1, 3]
    assert [r[0] for r in rows(done.holding)] == [1]


def test_inline_holdings_join_like_any_relation(spark):
    t = market(spark, Price=prices(spark, (1, "2024-01-02", 10)))
    held = portfolio.inline_holdings(spark, [("aaa", 2, 1)])
    assert rows(portfolio.value_series(t, held, "2024-01-01", "2024-12-31")) == [(0, d("2024-01-02"), 20.0)]


def test_a_security_in_all_portfolios_is_split(spark, monkeypatch):
    monkeypatch.setattr(portfolio, "SLOT_POSITIONS", 10)
    t = market(spark, Price=prices(spark, *[(1, f"2024-01-{d:02d}", 10 + d) for d in range(1, 29)]))
    held = spark.createDataFrame([(i, "AAA", 1.0 + i) for i in range(400)], "portfolio_id long, ticker string, shares double")
    got = portfolio.value_series(t, held, "2024-01-01", "2024-12-31")
    assert sorted(rows(got)) == sorted((i, d(f"2024-01-{k:02d}"), (10.0 + k) * (1 + i)) for i in range(400) for k in range(1, 29))


def test_series_of_all_is_valued_without_a_row_per_position_and_day(spark, monkeypatch):
    monkeypatch.setattr(portfolio, "SLOT_POSITIONS", 7)
    days = [f"2024-01-{k:02d}" for k in range(1, 29)]
    quotes = [(i, day, 10 * i + k) for i in (1, 2, 3) for k, day in enumerate(days) if (i + k) % 3]
    t = market(spark, Price=prices(spark, *quotes))
    names = {1: "AAA", 2: "BBB", 3: "CCC"}
    held = [(p, names[i], None if (p, i) == (4, 2) else p + i / 4) for p in range(30) for i in (1, 2, 3) if (p + i) % 4]
    held.append((99, "BBB", None))
    given = spark.createDataFrame(held, "portfolio_id long, ticker string, shares double")
    series = portfolio.value_series(t, given, "2024-01-03", "2024-01-20")
    want = {}
    for p, name, shares in held:
        for i, day, close in quotes:
            if names[i] == name and "2024-01-03" <= day <= "2024-01-20":
                before = want.get((p, d(day)))
                want[p, d(day)] = before if shares is None else (before or 0.0) + shares * close
    assert sorted(rows(series), key=str) == sorted(((p, day, v) for (p, day), v in want.items()), key=str)
    # The rows that are shuffled are positions and packed prices.
    plan = series._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate [portfolio_id" not in plan


def test_specs_are_dealt_by_key_before_they_are_taken_apart(spark):
    specs = spark.createDataFrame([(1, "AAA:1:2,bbb:3,AAA:4:5"), (2, "x"), (3, None)], "spec_id long, spec string")
    parsed = portfolio.parse_specs(specs)
    assert sorted(rows(parsed)) == [(1, "AAA", 4.0, 5.0, 0), (1, "BBB", 3.0, 0.0, 1)]
    plan = portfolio.parse_specs(specs)._jdf.queryExecution().executedPlan().toString()
    # No second shuffle of the entries, so neither are they aggregated in the tasks that read the files.
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")


def test_packed_prices_are_small_and_come_back_bit_by_bit(spark, monkeypatch):
    import numpy as np

    from marketloom.operators import valued

    some = np.random.default_rng(1)
    cents = some.integers(1, 10**7, 5000) / 100
    for keys, quotes in (
        (np.sort(some.choice(400_000, 5000, False)), cents), ([-5, -1, 3], [1.5, np.nan, 2.0]), ([7], [0.0]), ([0, 0, 2], [1 / 3, 2, 3]),
        ([-2**63, 2**63 - 1], [1e300, -0.0]), ([1, 2], [214748.3647, 99999999.9999]),
    ):
        keys, quotes = np.array(keys, "i8"), np.array(quotes, "f8")
        found = valued._pack(keys, quotes)
        back = valued._unpack(*found)
        assert back[0].tolist() == keys.tolist() and back[1].tobytes() == quotes.tobytes()
    first, steps, values = valued._pack(np.sort(some.choice(400_000, 5000, False)), cents)
    # They took 16 bytes each, in every block.
    assert len(steps) + len(values) < 5 * 5000


def test_blocks_are_dealt_to_more_tasks_than_a_session_has_partitions(spark, monkeypatch):
    monkeypatch.setattr(portfolio, "SLOT_POSITIONS", 10)
    t = market(spark, Price=prices(spark, (1, "2024-01-02", 10)))
    held = spark.createDataFrame([(i, "AAA", 1.0) for i in range(400)], "portfolio_id long, ticker string, shares double")
    got = portfolio.value_series(t, held, "2024-01-01", "2024-12-31")
    sizes = got.groupBy(F.spark_partition_id().alias("task")).count().collect()
    # 40 blocks over 8 x 3 tasks by number; a hash over three partitions gave a task all blocks of several.
    assert sum(r["count"] for r in sizes) == 400 and len(sizes) == 24
