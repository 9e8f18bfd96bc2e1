"""Registered sources, sinks and DDL: round trips over the derived tables."""

from __future__ import annotations

import uuid
from collections import ChainMap

from pyspark.sql import functions as F

from marketloom.operators import timeseries as ts
from marketloom.plans import portfolio, security
from marketloom.quality import constraints
from marketloom.schema import LOAD_ORDER, TABLES
from marketloom.session import scratch_path
from marketloom.sources import files, store
from marketloom.suite.derived_sql import rounded
from marketloom.suite.registry import END, START, TICKER, case, column_sql, line_sql

_DIGESTS = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, "
    f"CAST(COALESCE(SUM(CAST('0x' || SUBSTR(MD5({line_sql(n)}), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS digest FROM {n}"
    for n in LOAD_ORDER)
_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {n}" for n in LOAD_ORDER)
_MONEY = ("open", "high", "low", "close")
_GAPPED = "CASE WHEN volume % 7 <> 0 THEN open END"
_PRICE = ("SELECT security_id, trade_date, {open}, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, "
          "CAST(close AS DOUBLE) AS close, volume FROM Price")


def _gapped(tables):
    """Prices with some opening prices missing."""
    return tables["Price"].withColumn("open", F.when(F.col("volume") % 7 != 0, F.col("open")))


def _as_double(rows):
    return rows.select("security_id", "trade_date", *[F.col(c).cast("double").alias(c) for c in _MONEY], "volume")


@case("src_tsv", sql=_PRICE.format(open=f"CAST({_GAPPED} AS DOUBLE) AS open"))
def _(tables):
    path = scratch_path(tables.spark, "price-tsv")
    files.write_tsv(files.conform(_gapped(tables), TABLES["Price"]), path)
    return _as_double(files.read_tsv(tables.spark, path, "Price"))


@case("src_tsv_all_tables", sql=_DIGESTS, with_ids=True)
def _(tables):
    root = scratch_path(tables.spark, "tsv")
    landed = {}
    for name in LOAD_ORDER:
        files.write_tsv(files.conform(tables[name], TABLES[name]), f"{root}/{name}")
        landed[name] = files.read_tsv(tables.spark, f"{root}/{name}", name)
    return store.digests(landed)


def _damaged(tables):
    """Lines of the price file, some spoilt: a word for a number, a missing field, one too many, a wrong date, no close."""
    volume = F.col("volume")
    fields = {c: F.coalesce(F.col(c).cast("string"), F.lit(files.NULL_MARKER)) for c in TABLES["Price"].columns}

    def line(**other):
        return F.concat_ws("\t", *[other.get(c, value) for c, value in fields.items()])

    spoilt = (
        F.when(volume % 29 == 0, line(volume=F.lit("many")))
        .when(volume % 29 == 1, F.concat_ws("\t", *list(fields.values())[:-1]))
        .when(volume % 29 == 2, F.concat(line(), F.lit("\textra")))
        .when(volume % 29 == 3, line(trade_date=F.lit("1997-13-45")))
        .when(volume % 29 == 4, line(close=F.lit(files.NULL_MARKER), security_id=F.lit(files.NULL_MARKER)))
    )
    return files.conform(tables["Price"], TABLES["Price"]).select(spoilt.alias("value")).filter("value is not null")


_FIELDS = [f"COALESCE(CAST({column_sql(c)} AS VARCHAR), '\\N')" for c in TABLES["Price"].cols]


def _joined(fields):
    return f"CONCAT_WS(CHR(9), {', '.join(fields)})"


_NONE = "'\\N'"


@case("src_tsv_rejects", sql=f"""
    SELECT 'read' AS outcome, {line_sql('Price')} AS line FROM Price
    UNION ALL SELECT outcome, line FROM (
        SELECT CASE volume % 29 WHEN 4 THEN 'no value for security_id, close' ELSE 'fields do not fit' END AS outcome,
               CASE volume % 29
                   WHEN 0 THEN {_joined([*_FIELDS[:-1], "'many'"])}
                   WHEN 1 THEN {_joined(_FIELDS[:-1])}
                   WHEN 2 THEN {_joined([*_FIELDS, "'extra'"])}
                   WHEN 3 THEN {_joined([_FIELDS[0], "'1997-13-45'", *_FIELDS[2:]])}
                   WHEN 4 THEN {_joined([_NONE, *_FIELDS[1:5], _NONE, _FIELDS[6]])} END AS line
        FROM Price) AS spoilt WHERE line IS NOT NULL""")
def _(tables):
    root = scratch_path(tables.spark, "price-tsv")
    files.write_tsv(files.conform(tables["Price"], TABLES["Price"]), f"{root}/good")
    _damaged(tables).write.text(f"{root}/bad")
    good, bad = files.read_tsv_with_rejects(tables.spark, [f"{root}/good", f"{root}/bad"], "Price")
    read = good.select(F.lit("read").alias("outcome"), constraints.key_text(good.columns).alias("line"))
    return read.unionByName(bad.select(F.col("reason").alias("outcome"), "line"))


@case("src_null_marker", sql="SELECT symbol, long_name, short_name FROM raw_etf_info")
def _(tables):
    path = scratch_path(tables.spark, "names-tsv")
    rows = tables["raw_etf_info"].select("symbol", "long_name", "short_name")
    files.write_tsv(rows, path)
    return files.read_tsv(tables.spark, path, rows.schema)


@case("src_constituents_csv", sql="""
    SELECT symbol, security, sector, sub_industry || ', General' AS sub_industry FROM raw_constituents""")
def _(tables):
    path = scratch_path(tables.spark, "constituents-csv")
    rows = tables["raw_constituents"].withColumn("sub_industry", F.concat("sub_industry", F.lit(", General")))
    # A field the CSV reader would trim keeps its blanks when quoted.
    rows.select(*files.CONSTITUENT_COLUMNS).write.option("header", True).option("escape", '"').option(
        "quoteAll", True
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.read_constituents(tables.spark, path).drop("ordinal")


@case("src_fallback", sql="SELECT symbol, security, sector, sub_industry FROM raw_constituents")
def _(tables):
    raw = tables["raw_constituents"].select(*files.CONSTITUENT_COLUMNS)
    return files.first_available(None, raw.filter(F.col("sector") == "not delivered"), raw)


@case("sink_tsv", sql=f"""
    SELECT CONCAT_WS(CHR(9), security_id, trade_date, COALESCE(CAST({_GAPPED} AS VARCHAR), '\\N'),
                     high, low, close, volume) AS line
    FROM Price""")
def _(tables):
    path = scratch_path(tables.spark, "price-lines")
    rows = files.conform(_gapped(tables), TABLES["Price"])
    files.write_tsv(rows, path)
    lines = tables.spark.read.text(path).withColumnRenamed("value", "line")
    return lines.filter(F.col("line") != "\t".join(rows.columns))


@case("sink_json_rows", sql=_PRICE.format(open=f"CAST({_GAPPED} AS DOUBLE) AS open"))
def _(tables):
    path = scratch_path(tables.spark, "price-json")
    files.write_json_rows(files.conform(_gapped(tables), TABLES["Price"]), path)
    return _as_double(files.read_json_rows(tables.spark, path, TABLES["Price"].struct))


def _landed(tables, *names):
    """The tables with some derived once into files, for loads that read them several times."""
    root, landed = scratch_path(tables.spark, "landed"), {}
    for name in names:
        tables[name].write.parquet(f"{root}/{name}")
        landed[name] = tables.spark.read.schema(tables[name].schema).parquet(f"{root}/{name}")
    return ChainMap(landed, tables)


@case("sink_full_refresh", sql=_DIGESTS, with_ids=True)
def _(tables):
    spark, root = tables.spark, scratch_path(tables.spark, "store")
    # Two loads, each reading a table twice: once for the bounds of its ranges.
    landed = _landed(tables, *store.CLUSTERED)
    store.full_refresh(spark, landed, root, check=constraints.foreign_keys)
    store.full_refresh(spark, landed, root)
    return store.digests(store.open_store(spark, root))


@case("sink_full_refresh_price", sql=_PRICE.format(open="CAST(open AS DOUBLE) AS open"), with_ids=True)
def _(tables):
    root = scratch_path(tables.spark, "store")
    store.full_refresh(tables.spark, tables, root)
    return _as_double(store.open_store(tables.spark, root)["Price"])


@case("sink_daily_load", sql=f"""
    SELECT security_id, trade_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
           CAST(CASE WHEN trade_date > DATE '{END}' - 30 AND trade_date <= DATE '{END}' THEN close + 1 ELSE close END AS DOUBLE) AS close, volume
    FROM Price WHERE trade_date <= DATE '{END}'""", with_ids=True)
def _(tables):
    """A store loaded to the middle of a month, then the days of the last thirty: new ones, and others delivered anew."""
    spark, root = tables.spark, scratch_path(tables.spark, "store")
    day, end = F.col("trade_date"), F.lit(END).cast("date")
    store.full_refresh(spark, ChainMap({"Price": tables["Price"].filter(day <= F.date_sub(end, 15))}, tables), root)
    fresh = tables["Price"].filter((day > F.date_sub(end, 30)) & (day <= end))
    store.load_days(spark, root, fresh.withColumn("close", (F.col("close") + 1).cast("decimal(12,4)")))
    return _as_double(store.open_store(spark, root)["Price"])


@case("src_ticker_key", sql=f"""
    SELECT trade_date, CAST(close AS DOUBLE) AS close FROM Price JOIN Security USING (security_id)
    WHERE ticker = '{TICKER}' AND trade_date BETWEEN DATE '{START}' AND DATE '{END}'""", with_ids=True)
def _(tables):
    """A ticker looked up in the store, by its upper-case key."""
    root = scratch_path(tables.spark, "store")
    store.full_refresh(tables.spark, tables, root)
    return security.close_series(store.open_store(tables.spark, root), ticker=TICKER.lower(), start=START, end=END)


def _bucketed(tables, *only):
    """The given tables saved in buckets by security and read back."""
    spark = tables.spark
    path = scratch_path(spark, "buckets")
    # Names of their own: a table of an earlier call may still be read.
    database = f"bucketed_{path.rsplit('-', 1)[1]}"
    store.save_tables(spark, tables, database, int(spark.conf.get("spark.sql.shuffle.partitions")), path, list(only))
    return store.saved_tables(spark, database, list(only))


@case("win_lag_bucketed", sql="""
    SELECT security_id, trade_date, CAST(close AS DOUBLE) AS close,
           CAST(LAG(close) OVER (PARTITION BY security_id ORDER BY trade_date) AS DOUBLE) AS prev_close FROM Price""")
def _(tables):
    rows = ts.with_previous(_bucketed(tables, "Price")["Price"], "close", ["security_id"], ["trade_date"], "prev_close")
    return rows.select("security_id", "trade_date", *[F.col(c).cast("double").alias(c) for c in ("close", "prev_close")])


_DEVIATION = "STDDEV_SAMP(ret) OVER (PARTITION BY security_id ORDER BY trade_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


@case("win_rows_stddev_bucketed", sql=f"""
    WITH moved AS (SELECT security_id, trade_date, close, LAG(close) OVER (PARTITION BY security_id ORDER BY trade_date) AS prev_close FROM Price),
    kept AS (SELECT *, CAST(close - prev_close AS DOUBLE) / NULLIF(CAST(prev_close AS DOUBLE), 0) AS ret FROM moved WHERE prev_close IS NOT NULL)
    SELECT security_id, trade_date, {rounded(f'{_DEVIATION} * SQRT(CAST(252 AS DOUBLE)) * CAST(100 AS DOUBLE)', 2)} AS ann_vol_pct
    FROM kept WHERE ret IS NOT NULL""")
def _(tables):
    returns = ts.with_daily_return(_bucketed(tables, "Price")["Price"]).filter(F.col("ret").isNotNull())
    rows = returns.withColumn("dev", ts.rolling_rows(F.stddev_samp, "ret", security.ROLLING_ROWS))
    return rows.select("security_id", "trade_date", ts.annual_vol_pct(F.col("dev")).alias("ann_vol_pct"))


@case("join_asof_backward_bucketed", sql="""
    SELECT a.security_id, a.action_date, a.action_id, CAST(p.close AS DOUBLE) AS close FROM Corporate_Action a
    ASOF LEFT JOIN Price p ON a.security_id = p.security_id AND a.action_date >= p.trade_date""", with_ids=True)
def _(tables):
    saved = _bucketed(tables, "Price", "Corporate_Action")
    rows = ts.join_asof(saved["Corporate_Action"], saved["Price"], [ts.Leg("close")], by=["security_id"],
                        left_on="action_date", right_on="trade_date", value="close")
    return rows.select("security_id", "action_date", "action_id", F.col("close").cast("double").alias("close"))


@case("ddl_create", sql=_DIGESTS, with_ids=True)
def _(tables):
    """The relations as views, read by name, and unregistered again."""
    prefix = f"c{uuid.uuid4().hex[:8]}_"
    store.create_tables(tables.spark, tables, prefix)
    found = store.digests({n: tables.spark.table(f"{prefix}{n}") for n in LOAD_ORDER})
    store.drop_tables(tables.spark, prefix)
    return found


@case("ddl_drop", sql=f"SELECT table_name, n_rows, FALSE AS still_there FROM ({_COUNTS}) AS counted", with_ids=True)
def _(tables):
    spark = tables.spark
    prefix = f"d{uuid.uuid4().hex[:8]}_"
    store.create_tables(spark, tables, prefix)
    counted = store.row_counts({n: spark.table(f"{prefix}{n}") for n in LOAD_ORDER})
    store.drop_tables(spark, prefix)
    left = [n for n in LOAD_ORDER if spark.catalog.tableExists(f"{prefix}{n}")]
    return counted.withColumn("still_there", F.col("table_name").isin(left) if left else F.lit(False))


@case("src_inline_relation", sql=f"""
    WITH given AS (SELECT * FROM (VALUES ('S00003', 10.0), ('SPY', 5.0), ('ZZZ', 1.0)) AS v(ticker, shares))
    SELECT CAST(0 AS BIGINT) AS portfolio_id, trade_date,
           {rounded('SUM(CAST(close AS DOUBLE) * CAST(shares AS DOUBLE))', 2)} AS port_value
    FROM Price JOIN Security USING (security_id) JOIN given USING (ticker)
    WHERE trade_date BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY trade_date""")
def _(tables):
    held = portfolio.inline_holdings(tables.spark, [("S00003", 10, 150), ("SPY", 5, 300), ("ZZZ", 1, 1)])
    return portfolio.value_series(tables, held, start=START, end=END)
