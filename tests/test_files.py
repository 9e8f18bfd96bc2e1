from __future__ import annotations

import datetime as dt
import re

import pytest

from marketloom.quality import constraints
from marketloom.schema import LOAD_ORDER, TABLES
from marketloom.session import shared_dir
from marketloom.sources import files, store
from marketloom.operators import timeseries as ts
from marketloom.plans import security
from tests.market import d, market, prices, rows, table


def test_tsv_keeps_null_empty_and_quotes(spark, folder):
    data = spark.createDataFrame([("a", None, 1), ("b", "", None), ('c"d', "x\ty", 3)], "k string, v string, n int")
    files.write_tsv(data, f"{folder}/out")
    assert sorted(rows(files.read_tsv(spark, f"{folder}/out", data.schema))) == sorted(rows(data))
    lines = [r.value for r in spark.read.text(f"{folder}/out").collect()]
    assert "a\t\\N\t1" in lines and "k\tv\tn" in lines


def test_tsv_with_another_column_order_and_literal_quotes(spark, folder):
    with open(f"{folder}/t.tsv", "w") as f:
        f.write('sector_name\tsector_id\n"Tech\t1\n')
    got = files.read_tsv(spark, f"{folder}/t.tsv", "Sector", columns=["sector_name", "sector_id"], quoted=False)
    assert rows(got) == [(1, '"Tech')]


def test_constituents_csv_with_quoted_commas(spark, folder):
    with open(f"{folder}/c.csv", "w") as f:
        f.write('symbol,security,sector,sub_industry\nAAA,Alpha,Tech,"Hardware, Storage"\n')
    got = files.read_constituents(spark, f"{folder}/c.csv")
    assert rows(got.drop("ordinal")) == [("AAA", "Alpha", "Tech", "Hardware, Storage")]


def test_constituents_of_several_files_in_order_and_by_name(spark, folder):
    from marketloom.ingest import reference

    with open(f"{folder}/a.csv", "w") as f:
        f.write("sector,symbol,security,sub_industry\nTech,AAA,First,Soft\nTech,BBB,Beta,Soft\nTech,BBB,Later,Soft\n")
    with open(f"{folder}/b.csv", "w") as f:
        f.write("sector,symbol,security,sub_industry\nFin,AAA,Second,Ins\n")
    clean = reference.clean_constituents(files.read_constituents(spark, folder))
    assert sorted(rows(clean)) == [("AAA", "First", "Tech", "Soft"), ("BBB", "Beta", "Tech", "Soft")]


@pytest.mark.parametrize("text", ["sector_id\tsector_name\nabc\tTech\n", "sector_name\tsector_id\nTech\t1\n"])
def test_values_and_headers_that_do_not_fit_fail(spark, folder, text):
    with open(f"{folder}/t.tsv", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="(?i)malformed|header"):
        files.read_tsv(spark, f"{folder}/t.tsv", "Sector").collect()


def test_conform_fills_defaults_and_misses_required_columns(spark):
    given = spark.createDataFrame([(1, "Alpha", 2)], "company_id long, company_name string, industry_id long")
    assert rows(files.conform(given, TABLES["Company"])) == [(1, "Alpha", 2, "US")]
    with pytest.raises(ValueError, match="company_name"):
        files.conform(given.drop("company_name"), TABLES["Company"])


def test_first_available(spark):
    some, none = spark.range(1), spark.range(0)
    assert files.first_available(none, some) is some
    assert files.first_available(some, none) is some
    with pytest.raises(ValueError):
        files.first_available(None, none)


def test_json_rows_keep_null(spark, folder):
    data = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows(files.json_rows(data)) == [('{"a":1,"b":null}',)]
    files.write_json_rows(data, f"{folder}/j")
    assert rows(files.read_json_rows(spark, f"{folder}/j", data.schema)) == [(1, None)]


def stocked(spark):
    return market(
        spark,
        Price=prices(spark, (1, "2023-12-29", 9), (1, "2024-01-02", 10), (1, "2024-01-03", 11), (4, "2022-05-02", 1)),
        Financial_Snapshot=[(1, 1, "2024-03-31", 5, None, None, None)],
        Corporate_Action=[(1, 1, "2024-03-31", "spinoff", None)],
    )


def test_refresh_replaces_the_store_as_a_whole(spark, folder):
    t = stocked(spark)
    assert store.current_version(spark, folder) == 0
    assert store.full_refresh(spark, t, folder, check=constraints.all_violations) == 1
    loaded = store.open_store(spark, folder)
    for name in LOAD_ORDER:
        assert sorted(rows(loaded[name].select(*TABLES[name].columns)), key=str) == sorted(rows(t[name]), key=str), name

    bad = {**t, "Holding": table(spark, "Holding", [(1, 99, 1, 1)])}
    with pytest.raises(ValueError, match="rejected"):
        store.full_refresh(spark, bad, folder, check=constraints.foreign_keys)
    assert store.current_version(spark, folder) == 1
    assert store.open_store(spark, folder)["Holding"].count() == 2

    smaller = {**t, "Holding": t["Holding"].limit(1)}
    assert store.full_refresh(spark, smaller, folder) == 2
    assert store.open_store(spark, folder)["Holding"].count() == 1


def test_a_date_range_prunes_year_folders(spark, folder):
    store.full_refresh(spark, stocked(spark), folder)
    query = security.close_series(store.open_store(spark, folder), "AAA", "2024-01-01", "2024-12-31")
    assert rows(query) == [(d("2024-01-02"), 10.0), (d("2024-01-03"), 11.0)]
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "trade_date_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert re.search(r"security_id#\d+L? >= (ReusedSubquery )?[Ss]ubquery", plan), plan


def test_bucketed_tables_need_no_shuffle_per_security(spark):
    store.save_tables(spark, stocked(spark), "bucketed", buckets=3)
    saved = store.saved_tables(spark, "bucketed")
    returns = ts.with_daily_return(saved["Price"])
    assert "Exchange" not in returns._jdf.queryExecution().executedPlan().toString()
    ends = ts.endpoints_in_range(saved["Price"], "2024-01-01", "2024-12-31")
    assert "Exchange" not in ends._jdf.queryExecution().executedPlan().toString()
    assert rows(ends.select("security_id")) == [(1,)]
    assert rows(security.close_series(saved, "AAA", "2024-01-03", "2024-12-31")) == [(d("2024-01-03"), 11.0)]


def test_create_and_drop_tables(spark):
    store.create_tables(spark, prefix="x_")
    assert spark.table("x_price").count() == 0
    assert [f.dataType.simpleString() for f in spark.table("x_etf").schema] == ["bigint", "string", "decimal(6,4)"]
    assert store.drop_tables(spark, "x_")[0] == "Corporate_Action"
    assert store.drop_tables(spark, "x_") == []


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert dt.date(2024, 1, 1) == d("2024-01-01")


def test_a_change_of_portfolios_leaves_other_files_alone(spark, folder):
    t = stocked(spark)
    store.full_refresh(spark, t, folder)
    before = sorted(store.open_store(spark, folder)["Price"].inputFiles())
    changed = {"Portfolio": t["Portfolio"], "Holding": t["Holding"].limit(1)}
    assert store.commit_tables(spark, changed, folder, based_on=1) == 2
    after = store.open_store(spark, folder)
    assert sorted(after["Price"].inputFiles()) == before and after["Holding"].count() == 1


def test_two_writers_cannot_take_one_version(spark, folder):
    t = stocked(spark)
    store.full_refresh(spark, t, folder)
    store.commit_tables(spark, {"Holding": t["Holding"].limit(1)}, folder, based_on=1)
    with pytest.raises(ValueError, match="another writer"):
        store.commit_tables(spark, {"Holding": t["Holding"].limit(0)}, folder, based_on=1)
    assert store.open_store(spark, folder)["Holding"].count() == 1


def test_saved_tables_can_be_dropped(spark):
    store.save_tables(spark, stocked(spark), "gone", buckets=2)
    store.drop_saved_tables(spark, "gone")
    store.drop_saved_tables(spark, "gone")
    assert not spark.catalog.tableExists("gone.price")


def test_saving_and_deleting_by_name(spark):
    from marketloom.plans import catalog

    t = stocked(spark)
    assert rows(catalog.run("pf_save", t, owner="nobody", portfolio_name="x", holdings="AAA:1:2").select("error")) == [("invalid owner",)]
    saved = catalog.run("pf_save", t, owner="u:9", portfolio_name="x", holdings="AAA:1:2").collect()
    assert [(r.saved, r.error) for r in saved] == [(1, None)]
    assert rows(catalog.run("pf_delete", t, owner="u:9", pid=12345).select("deleted")) == [(0,)]


def test_lines_that_do_not_fit_are_returned(spark, folder):
    with open(f"{folder}/t.tsv", "w") as f:
        f.write("sector_id\tsector_name\n1\tTech\nabc\tFin\n3\n4\tA\tB\n\n\\N\tNone\n6\t\\N\n7\t\"quo\"\"ted\"\n")
    good, bad = files.read_tsv_with_rejects(spark, f"{folder}/t.tsv", "Sector")
    assert sorted(rows(good)) == [(1, "Tech"), (7, 'quo"ted')]
    assert sorted((r.table_name, r.line, r.reason) for r in bad.collect()) == sorted([
        ("Sector", "abc\tFin", "fields do not fit"), ("Sector", "3", "fields do not fit"), ("Sector", "4\tA\tB", "fields do not fit"),
        ("Sector", "\\N\tNone", "no value for sector_id"), ("Sector", "6\t\\N", "no value for sector_name")])
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"t.tsv"}
    assert good.schema == TABLES["Sector"].struct


def test_rejects_keep_nullable_columns_and_other_orders(spark, folder):
    with open(f"{folder}/t.tsv", "w") as f:
        f.write("trade_date\tsecurity_id\tclose\n2024-01-02\t1\t1.5\n2024-02-30\t1\t1.5\n")
    good, bad = files.read_tsv_with_rejects(spark, f"{folder}/t.tsv", "Price", columns=["trade_date", "security_id", "close"])
    assert [(r.security_id, r.trade_date, r.open, float(r.close), r.volume) for r in good.collect()] == [(1, d("2024-01-02"), None, 1.5, 0)]
    assert [r.line for r in bad.collect()] == ["2024-02-30\t1\t1.5"]


def stored_market(spark, folder):
    t = market(spark, Price=prices(spark, (1, "2022-05-02", 1), (1, "2023-05-02", 2), (2, "2023-06-02", 3), (1, "2024-01-02", 4)))
    store.full_refresh(spark, t, folder)
    return t


def files_of(spark, folder):
    return {f.rsplit("/", 2)[1] + "/" + f.rsplit("/", 1)[1] for f in store.open_store(spark, folder)["Price"].inputFiles()}


def test_a_daily_load_rewrites_only_the_years_it_touches(spark, folder):
    stored_market(spark, folder)
    before = files_of(spark, folder)
    fresh = prices(spark, (1, "2023-05-02", 20), (2, "2023-05-03", 30), (1, "2025-01-02", 40))
    assert store.load_days(spark, folder, fresh) == [2023, 2025]
    after = files_of(spark, folder)
    other = {f for f in before if "=2023" not in f}
    assert other and other <= after
    assert not {f for f in before if "=2023" in f} & after
    got = sorted((r.security_id, str(r.trade_date), float(r.close)) for r in store.open_store(spark, folder)["Price"].collect())
    assert got == [(1, "2022-05-02", 1.0), (1, "2023-05-02", 20.0), (1, "2024-01-02", 4.0), (1, "2025-01-02", 40.0),
                   (2, "2023-05-03", 30.0), (2, "2023-06-02", 3.0)]
    assert store.current_version(spark, folder) == 1
    assert store.load_days(spark, folder, fresh.limit(0)) == []
    # Loading the same days again changes nothing.
    store.load_days(spark, folder, fresh)
    assert sorted((r.security_id, str(r.trade_date), float(r.close)) for r in store.open_store(spark, folder)["Price"].collect()) == got


def test_the_ticker_reaches_the_scan_of_the_store(spark, folder):
    t = stored_market(spark, folder)
    saved = store.open_store(spark, folder)
    ticker = t["Security"].first()["ticker"]
    found = security.close_series(saved, ticker=f" {ticker.lower()} ", start="2020-01-01", end="2030-01-01")
    assert rows(found) == rows(security.close_series(t, ticker=ticker, start="2020-01-01", end="2030-01-01"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(ticker_key," + ticker.upper(), plan), plan
    assert "upper(" not in plan


def test_windows_over_bucketed_tables_need_no_exchange(spark):
    from marketloom.suite import all_cases
    from tests.conftest import SMALL

    for key in ("win_lag_bucketed", "win_rows_stddev_bucketed"):
        plan = all_cases()[key].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan, key


def test_a_changed_cell_changes_the_digest(spark):
    from pyspark.sql import functions as F

    t = market(spark, Price=prices(spark, (1, "2024-01-02", 10), (2, "2024-01-02", 11), (2, "2024-01-03", None)))
    plain = store.digests(t).collect()
    assert sorted(plain) == sorted(store.digests({n: r.repartition(5) for n, r in t.items()}).collect())
    changed = t["Price"].withColumn("close", F.when((F.col("security_id") == 2) & F.col("close").isNotNull(), 12).otherwise(F.col("close")))
    other = {r.table_name: r.digest for r in store.digests({**t, "Price": changed}).collect()}
    assert [r.table_name for r in plain if other[r.table_name] != r.digest] == ["Price"]
    twice = store.digests({**t, "Price": t["Price"].union(t["Price"])}, only=["Price"]).first()
    assert twice.digest != [r.digest for r in plain if r.table_name == "Price"][0]


def test_old_loads_are_dropped(spark, folder):
    assert store.drop_old_loads(spark, folder) == []
    t = stored_market(spark, folder)
    store.commit_tables(spark, {"Price": t["Price"]}, folder)
    with pytest.raises(ValueError, match="rejected"):
        store.full_refresh(spark, t, folder, check=lambda tables: tables["Price"])
    store.load_days(spark, folder, prices(spark, (1, "2023-05-02", 20)))
    before = sorted(map(tuple, store.digests(store.open_store(spark, folder)).collect()))
    # The refused load and the staged days go; the first load still holds twelve tables.
    gone = store.drop_old_loads(spark, folder)
    assert [name.split("-")[0] for name in gone] == ["load", "stage"]
    assert sorted(map(tuple, store.digests(store.open_store(spark, folder)).collect())) == before
    store.full_refresh(spark, t, folder)
    assert len(store.drop_old_loads(spark, folder)) == 2
    assert store.drop_old_loads(spark, folder) == []


def test_a_line_is_parsed_once_for_each_relation(spark, folder):
    with open(f"{folder}/t.tsv", "w") as f:
        f.write("sector_id\tsector_name\n1\tTech\nx\tFin\n\\N\tOil\n3\n")
    good, bad = files.read_tsv_with_rejects(spark, f"{folder}/t.tsv", "Sector")
    assert rows(good) == [(1, "Tech")]
    assert sorted((r.line, r.reason) for r in bad.collect()) == [
        ("3", "fields do not fit"), ("\\N\tOil", "no value for sector_id"), ("x\tFin", "fields do not fit")]
    for part in (good, bad):
        assert part._jdf.queryExecution().executedPlan().toString().count("from_csv(") == 1


def test_two_loads_derive_the_large_tables_once(spark, monkeypatch):
    from marketloom.suite import all_cases
    from tests.conftest import SMALL

    given = []

    def write(rows, name, path, **options):
        given.append((name, rows._jdf.queryExecution().optimizedPlan().toString()))
        return stored(rows, name, path, **options)

    stored = store._write
    monkeypatch.setattr(store, "_write", write)
    assert all_cases()["sink_full_refresh"].run(spark, SMALL).count() == 13
    plans = [plan for name, plan in given if name in store.CLUSTERED]
    assert len(plans) == 2 * len(store.CLUSTERED) and not [plan for plan in plans if "Aggregate" in plan or "Union" in plan]
