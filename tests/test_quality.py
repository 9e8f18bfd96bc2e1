from __future__ import annotations

from marketloom.quality import changes, constraints
from marketloom.sources import files
from tests.market import d, market, prices, rows, table


def full(spark, **overrides):
    given = {
        "Price": prices(spark, (1, "2024-01-02", 10), (2, "2024-01-02", 10)),
        "Financial_Snapshot": [(1, 1, "2024-03-31", 5, None, None, None)],
        "Corporate_Action": [(1, 1, "2024-03-31", "spinoff", None)],
        **overrides,
    }
    return market(spark, **given)


def test_clean_tables_break_nothing(spark):
    assert rows(constraints.all_violations(full(spark))) == []


def test_keys(spark):
    doubled = prices(spark, (1, "2024-01-02", 10), (1, "2024-01-02", 11), (None, "2024-01-02", 1))
    assert sorted(rows(constraints.primary_keys(full(spark, Price=doubled), ["Price"]))) == [
        ("Price", "primary key", "1|2024-01-02", 2), ("Price", "primary key", "NULL|2024-01-02", 1)]
    twins = [(1, "AAA", 1, "USD", "stock"), (2, "AAA", 1, "USD", "stock"), (3, None, 1, "USD", "stock"), (4, None, 1, "USD", "etf")]
    assert rows(constraints.unique_sets(full(spark, Security=twins), ["Security"])) == [
        ("Security", "unique ticker,exchange_id", "AAA|1", 2)]


def test_orphans_are_counted_per_key(spark):
    t = full(spark, Price=prices(spark, (9, "2024-01-02", 1), (9, "2024-01-03", 1), (1, "2024-01-02", 1)))
    assert rows(constraints.foreign_keys(t, ["Price"])) == [("Price", "security_id -> Security", "9", 2)]


def test_values(spark):
    holding = [(1, 1, 0, 5), (2, 4, 1, -1)]
    options = [(1, 5, "2025-04-18", 0, "call", 0.3, None), (2, 5, "2025-04-18", 1, "straddle", 0.3, -1)]
    t = full(spark, Holding=holding, Option_Contract=options)
    assert sorted(rows(constraints.value_checks(t, ["Holding", "Option_Contract"]))) == [
        ("Holding", "average_cost >= 0", "2|4", 1), ("Holding", "shares > 0", "1|1", 1),
        ("Option_Contract", "open_interest >= 0", "2", 1), ("Option_Contract", "strike_price > 0", "1", 1)]
    assert rows(constraints.value_sets(t, ["Option_Contract"])) == [("Option_Contract", "option_type in set", "2", 1)]
    gaps = [(1, None, 1), (2, "x" * 101, None)]
    t = full(spark, Industry=gaps)
    assert sorted(rows(constraints.not_null(t, ["Industry"]))) == [
        ("Industry", "industry_name not null", "1", 1), ("Industry", "sector_id not null", "2", 1)]
    assert rows(constraints.text_lengths(t, ["Industry"])) == [("Industry", "industry_name length <= 100", "2", 1)]


def test_subtypes_and_dependencies(spark):
    t = full(spark, Stock=[(1, 1), (2, 2), (4, 3)])
    assert sorted(rows(constraints.subtype_agreement(t))) == [
        ("Security", "Stock row is a stock", "4", 1), ("Security", "stock has a Stock row", "3", 1)]
    t = full(spark, Sector=[(1, "A"), (1, None), (2, "B"), (2, "B")])
    assert rows(constraints.functional_dependencies(t, ["Sector"])) == [("Sector", "sector_id -> sector_name", "1", 2)]


def test_defaults_fill_only_absent_columns(spark):
    given = spark.createDataFrame([(1, None)], "company_id long, country string")
    assert rows(files.with_defaults(given, "Company")) == [(1, None)]
    assert rows(files.with_defaults(given.drop("country"), "Company")) == [(1, "US")]


def test_ids_continue_in_order(spark):
    base = table(spark, "Portfolio", [(7, "a", "x")])
    new = spark.createDataFrame([("c", "x"), ("b", "y")], "portfolio_name string, owner_name string")
    got = changes.append_rows(base, new, "portfolio_id", ["portfolio_name"])
    assert sorted(rows(got)) == [(7, "a", "x"), (8, "b", "y"), (9, "c", "x")]
    empty = changes.append_rows(base, new.limit(0), "portfolio_id", ["portfolio_name"])
    assert rows(empty) == [(7, "a", "x")]


def test_dense_ids_over_many_partitions(spark):
    from marketloom.operators.keys import assign_ids

    data = spark.range(0, 5000, numPartitions=7).selectExpr("5000 - id AS v")
    got = assign_ids(data, ["v"], "id", start=10, partitions=16)
    assert got.filter("id = v + 9").count() == 5000


def test_ids_need_no_job_and_no_copy_of_the_rows(spark):
    from marketloom.operators import keys

    data = spark.createDataFrame([(f"s{i % 97:03d}", None if i % 5 == 0 else i, i) for i in range(3000)], "a string, b long, c long")
    spark.sparkContext.setJobGroup("ids", "ids")
    got = keys.assign_ids(data, ["a", "b", "c"], "id", partitions=40)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ids")
    spark.sparkContext.setJobGroup("", "")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan.replace("Scan ExistingRDD[a", "")
    found = sorted(map(tuple, got.collect()))
    wanted = sorted(((a, b, c) for a, b, c in map(tuple, data.collect())), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    assert found == [(i, *r) for i, r in enumerate(wanted, 1)]


def test_rows_of_one_leading_value_are_spread_over_ranges(spark):
    from pyspark.sql import functions as F

    from marketloom.operators import keys

    data = spark.range(20000).select(F.lit("same").alias("a"), F.col("id").alias("b"))
    keyed = data.withColumn("k", F.struct("a", "b"))
    bounds = keys._bounds(keyed.select(F.col("k").alias("__key")), 64)
    placed = keyed.withColumn("bounds", bounds).select(keys._range_of(F.col("bounds"), F.col("k")).alias("r"))
    sizes = [r["count"] for r in placed.groupBy("r").count().collect()]
    assert len(sizes) >= 64 and max(sizes) < 20000 / 64 * 2.5


def faulty(spark):
    """Tables that break every kind of rule, some rows several rules at once."""
    t = dict(full(spark))
    industry = t["Industry"]
    t["Industry"] = industry.unionByName(industry.withColumn("sector_id", industry.sector_id + 50))
    t["Price"] = t["Price"].unionByName(t["Price"].selectExpr(
        "security_id", "cast(null as date) as trade_date", "open", "high", "low", "cast(null as decimal(12,4)) as close", "-volume - 1 as volume"))
    t["Security"] = t["Security"].unionByName(t["Security"].selectExpr(
        "security_id + 900 as security_id", "ticker", "exchange_id", "repeat('x', 11) as currency", "'bond' as security_type"))
    return t


def test_all_checks_together_find_what_each_finds(spark):
    t = faulty(spark)
    checks = (constraints.primary_keys, constraints.unique_sets, constraints.foreign_keys, constraints.value_checks, constraints.not_null,
              constraints.value_sets, constraints.text_lengths, constraints.subtype_agreement, constraints.functional_dependencies)
    single = [sorted(map(tuple, check(t).collect())) for check in checks]
    assert all(single[:7]) and single[8]
    assert sorted(map(tuple, constraints.all_violations(t).collect())) == sorted(r for found in single for r in found)


def test_dependencies_take_one_exchange_per_key_set(spark):
    t = market(spark)
    found = constraints.functional_dependencies(t, only=["Price"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    both = constraints.functional_dependencies(t, only=["Financial_Snapshot"])._jdf.queryExecution().executedPlan().toString()
    assert both.count("Exchange ") == 2


def test_row_rules_scan_a_table_once(spark, folder):
    t = dict(full(spark))
    t["Price"].write.parquet(f"{folder}/p")
    t["Price"] = spark.read.parquet(f"{folder}/p")
    plan = constraints.all_violations(t, only=["Price"])._jdf.queryExecution().executedPlan().toString()
    # Row rules, the key set and the reference: one scan each.
    assert plan.count("FileScan parquet") == 3


def test_a_missing_value_is_a_value_of_a_dependent(spark):
    t = {"Stock": spark.createDataFrame([(1, 1), (1, None), (2, None), (2, None), (3, 5), (3, 5)], "security_id long, company_id long")}
    assert rows(constraints.functional_dependencies(t)) == [("Stock", "security_id -> company_id", "1", 2)]


def test_deletes_and_renames_follow_the_references(spark):
    t = full(spark)
    gone = spark.createDataFrame([(1,)], "security_id long")
    left = changes.delete_cascade(t, "Security", gone)
    assert rows(left["Holding"].select("security_id")) == [(4,)]
    assert rows(left["Price"].select("security_id")) == [(2,)]
    assert sorted(left) == ["Corporate_Action", "ETF", "Financial_Snapshot", "Holding", "Option_Contract", "Price",
                            "Security", "Stock"]
    allowed, refused = changes.delete_restrict(t, "Sector", spark.createDataFrame([(1,), (9,)], "sector_id long"))
    assert (rows(allowed), rows(refused)) == ([(9,)], [(1,)])
    moved = changes.update_cascade(t, "Security", spark.createDataFrame([(1, 100)], "old long, new long"))
    assert sorted(rows(moved["Price"].select("security_id", "trade_date"))) == [(2, d("2024-01-02")), (100, d("2024-01-02"))]
    assert sorted(rows(moved["Stock"])) == [(2, 2), (3, 3), (100, 1)]


def test_delete_keeps_rows_that_restricting_children_use(spark):
    from marketloom.quality import changes
    from tests.market import market, rows

    t = market(spark)
    every = t["Sector"].select("sector_id")
    left = changes.delete_cascade(t, "Sector", every)
    assert sorted(rows(left["Sector"])) == sorted(rows(t["Sector"].join(t["Industry"].select("sector_id").distinct(), "sector_id", "left_semi")))


def test_ranges_of_ids_are_found_by_compiled_steps(spark):
    from pyspark.sql import functions as F

    from marketloom.operators import keys

    data = spark.range(3000).selectExpr("id % 40 AS a", "CASE WHEN id % 7 <> 0 THEN id END AS b")
    key = F.struct("a", "b")
    bounds = keys._bounds(data.select(key.alias("__key")), 64)
    placed = keys._with_range(data, bounds, key, 64).withColumn("bounds", bounds)
    assert placed.filter(F.col("__range") != keys._range_of(F.col("bounds"), key, 64)).count() == 0
    # A search by a higher-order function was interpreted for every row, and the key travelled twice.
    plan = keys.assign_ids(data, ["a", "b"], "id", partitions=40)._jdf.queryExecution().executedPlan().toString()
    searches = [line for line in plan.splitlines() if "lambdafunction" in line and "__range" in line and "sizes" not in line]
    assert not searches and "__key" not in [line for line in plan.splitlines() if "+- Window" in line or "Window [" in line][0]


def test_ids_are_planned_in_time_with_many_partitions(spark):
    from pyspark.sql import functions as F

    from marketloom.operators import keys

    data = spark.range(3000).selectExpr("id % 40 AS a", "id AS b")
    numbered = keys.assign_ids(data, ["a", "b"], "id", partitions=2048)
    # The steps of the search end in a generated number; followed back through all thirteen, a key had 3 ** 13 parts.
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(array(__range" in plan
    assert numbered.filter(F.col("id").between(1, 3000)).select("id").distinct().count() == 3000
