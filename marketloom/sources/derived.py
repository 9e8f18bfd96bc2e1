"""Finance relations derived from the star-schema test tables.

region is read as sector, nation as industry, supplier as company and stock,
lineitem as price ticks, part as option contract, customer as portfolio. Every
relation is a lazy plan over the given Parquet files and grows with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.keys import assign_ids, spread

# Read schemas of the given tables: naming them saves a footer job per table.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}

# Stocks keep the suppliers' keys, so funds and options lie below zero: no number of keys makes them meet.
BASKET_ID = -1
OPTION_BASE = -10
WIDE_SLOTS = 8


def _long(x) -> Column:
    return F.lit(x).cast("long") if isinstance(x, int) else F.col(x).cast("long")


def _padded(key) -> Column:
    """At least five digits; longer keys are kept whole."""
    digits = F.col(key).cast("string")
    return F.lpad(digits, F.greatest(F.lit(5), F.length(digits)), F.lit("0"))


def _ticker(key) -> Column:
    return F.concat(F.lit("S"), _padded(key))


def _inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Constant rows as a plan of literals, so no Python data is shipped."""
    fields = T.StructType.fromDDL(schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


class DerivedTables(Mapping[str, DataFrame]):
    """The derived relations by name, each planned when first asked for.

    ``with_ids`` adds the dense ``snapshot_id`` and ``action_id``; they cost a
    global ordering, so analyses, which never read them, go without.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, with_ids: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.with_ids = with_ids
        self._plans: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in BUILDERS:
            raise KeyError(name)
        if name not in self._plans:
            self._plans[name] = BUILDERS[name](self)
        return self._plans[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)

    def base(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")


BUILDERS: dict[str, Callable[[DerivedTables], DataFrame]] = {}


def _builds(name: str):
    def register(fn):
        BUILDERS[name] = fn
        return fn

    return register


@_builds("Sector")
def _sector(t):
    return t.base("region").select(_long("r_regionkey").alias("sector_id"), F.col("r_name").alias("sector_name"))


@_builds("Industry")
def _industry(t):
    return t.base("nation").select(
        _long("n_nationkey").alias("industry_id"),
        F.col("n_name").alias("industry_name"),
        _long("n_regionkey").alias("sector_id"),
    )


@_builds("Company")
def _company(t):
    return t.base("supplier").select(
        F.col("s_suppkey").alias("company_id"),
        F.col("s_name").alias("company_name"),
        _long("s_nationkey").alias("industry_id"),
        F.lit("US").alias("country"),
    )


@_builds("Exchange")
def _exchange(t):
    return _inline(
        t.spark,
        [
            (1, "X1", "US", "America/New_York"),
            (2, "X2", "US", "America/New_York"),
            (3, "X3", "US", "America/Chicago"),
        ],
        "exchange_id long, exchange_name string, country string, timezone string",
    )


@_builds("Stock")
def _stock(t):
    return t.base("supplier").select(F.col("s_suppkey").alias("security_id"), F.col("s_suppkey").alias("company_id"))


@_builds("ETF")
def _etf(t):
    return _inline(
        t.spark,
        [(BASKET_ID, "Market Basket", "0.0945"), (BASKET_ID - 1, "Promo Basket", "0.2")],
        "security_id long, fund_name string, expense_ratio decimal(6,4)",
    )


@_builds("Option_Contract")
def _option(t):
    n_suppliers = t.base("supplier").agg(F.count("*").alias("n")).scalar()
    size = F.col("p_size") % 4
    expiry = (
        F.when(size == 0, "2001-03-16").when(size == 1, "2001-06-15").when(size == 2, "2001-12-21").otherwise("2002-06-21")
    )
    return t.base("part").select(
        F.col("p_partkey").alias("option_id"),
        (F.lit(OPTION_BASE) - F.col("p_partkey")).alias("security_id"),
        (F.col("p_partkey") % n_suppliers).alias("underlying_id"),
        expiry.cast("date").alias("expiration_date"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("strike_price"),
        F.when(F.col("p_type").isin("PROMO", "SMALL", "LARGE"), "call").otherwise("put").alias("option_type"),
        (F.col("p_size") / F.lit(100.0)).cast("decimal(8,4)").alias("implied_volatility"),
        (F.col("p_partkey") * 7 % 1000).cast("int").alias("open_interest"),
    )


@_builds("Security")
def _security(t):
    def listed(rows, ticker, exchange, kind):
        return rows.select(
            "security_id",
            ticker.alias("ticker"),
            exchange.cast("long").alias("exchange_id"),
            F.lit("USD").alias("currency"),
            F.lit(kind).alias("security_type"),
        )

    stocks = listed(t["Stock"], _ticker("security_id"), 1 + F.col("security_id") % 2, "stock")
    funds = listed(t["ETF"], F.when(F.col("fund_name") == "Market Basket", "SPY").otherwise("PRM"), F.lit(2), "etf")
    options = listed(
        t["Option_Contract"],
        F.concat(_ticker("underlying_id"), F.lit("O"), F.col("option_id").cast("string")),
        F.lit(3),
        "option",
    )
    return stocks.unionByName(funds).unionByName(options)


def _ticks(t) -> DataFrame:
    return t.base("lineitem").select(
        F.col("l_suppkey").alias("security_id"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").alias("px"),
        F.col("l_quantity").alias("qty"),
        "l_returnflag",
        F.col("l_discount").cast("decimal(6,4)").alias("disc"),
    )


@_builds("Price")
def _price(t):
    # (order, line, part) packed into one fixed-width number keeps the
    # aggregation on the hash path; a struct would force a sort.
    wide = "decimal(38,0)"
    sequence = (
        F.col("l_orderkey").cast("decimal(19,0)") * F.lit(10**15).cast("decimal(16,0)")
        + (F.col("l_linenumber").cast("long") * F.lit(10**14) + F.col("l_partkey")).cast("decimal(19,0)")
    ).cast(wide)

    def money(agg):
        return agg.cast("decimal(12,4)")

    ticks = _ticks(t)
    daily = ticks.groupBy("security_id", "trade_date").agg(
        money(F.min_by("px", sequence)).alias("open"),
        money(F.max("px")).alias("high"),
        money(F.min("px")).alias("low"),
        money(F.max_by("px", sequence)).alias("close"),
        F.sum(F.col("qty").cast("long")).alias("volume"),
    )
    # Extremes and sums of the daily bars are those of the ticks, which combine to a row per day before the shuffle.
    basket = (
        ticks.groupBy("trade_date")
        .agg(money(F.min("px")).alias("low"), money(F.max("px")).alias("high"), F.sum(F.col("qty").cast("long")).alias("volume"))
        .select(
            # Made from a column, so that joins keep it as a key.
            (F.col("volume") * 0 + BASKET_ID).alias("security_id"),
            "trade_date",
            F.col("low").alias("open"),
            "high",
            "low",
            F.col("high").alias("close"),
            "volume",
        )
    )
    return daily.unionByName(basket)


def _mean(total: str, scale: int) -> Column:
    """A mean per line in whole parts of ``scale``: it stays in a narrow column however many lines a quarter has."""
    return F.expr(f"({total} * {scale}) div n").cast("decimal(10,0)")


@_builds("Financial_Snapshot")
def _snapshot(t):
    sid = F.col("security_id")
    scale = (
        F.when(sid % 5 == 0, 1_000_000_000)
        .when(sid % 5 == 1, 100_000_000)
        .when(sid % 5 == 2, 10_000_000)
        .when(sid % 5 == 3, 1_000_000)
        .otherwise(100_000)
    )
    quarters = (
        _ticks(t)
        .groupBy(sid, F.year("trade_date").alias("y"), F.quarter("trade_date").alias("q"))
        .agg(
            F.max("trade_date").alias("snapshot_date"),
            F.sum(F.col("qty").cast("long")).alias("qty"),
            (F.sum("disc") * 1_000_000).cast("long").alias("disc"),
            F.count("*").alias("n"),
        )
    )
    pe = (
        F.when(sid % 11 == 10, F.lit(None))
        .when(sid % 13 == 12, F.lit("-1.5").cast("decimal(10,2)"))
        .otherwise(_mean("qty", 25) * F.lit("0.05").cast("decimal(3,2)"))
    )
    snaps = quarters.select(
        sid,
        "snapshot_date",
        (F.col("qty") * scale).alias("market_cap"),
        pe.cast("decimal(10,2)").alias("pe_ratio"),
        F.when(F.col("n") % 17 != 0, (_mean("disc", 1) * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(10,4)")).alias("eps"),
        (_mean("qty", 200) * F.lit("0.0005").cast("decimal(4,4)")).cast("decimal(6,4)").alias("beta"),
    )
    if t.with_ids:
        return assign_ids(snaps, ["security_id", "snapshot_date"], "snapshot_id")
    return snaps


@_builds("Corporate_Action")
def _action(t):
    line = F.col("l_linenumber")
    kind = F.when(line <= 5, "dividend").when(line == 6, "split").otherwise("reverse_split")
    amount = F.when(line <= 5, F.col("disc") * 10).when(line == 6, F.lit(2)).otherwise(F.lit("0.5").cast("decimal(2,1)"))
    rows = _ticks(t).filter(F.col("l_returnflag") == "R")
    columns = [
        F.col("security_id"),
        F.col("trade_date").alias("action_date"),
        kind.alias("action_type"),
        amount.cast("decimal(14,6)").alias("amount"),
    ]
    if not t.with_ids:
        return rows.select(*columns)
    order = ["security_id", "trade_date", "l_orderkey", "l_linenumber", "l_partkey"]
    return assign_ids(rows, order, "action_id").select("action_id", *columns)


@_builds("Portfolio")
def _portfolio(t):
    owner = F.when(
        F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("u:"), (F.col("c_custkey") % 10).cast("string"))
    ).otherwise(F.col("c_mktsegment"))
    return t.base("customer").select(
        F.col("c_custkey").alias("portfolio_id"), F.col("c_name").alias("portfolio_name"), owner.alias("owner_name")
    )


@_builds("Holding")
def _holding(t):
    lots = t.base("lineitem").select("l_orderkey", F.col("l_suppkey").alias("security_id"), "l_quantity", "l_extendedprice")
    held = t.base("orders").join(lots, F.col("o_orderkey") == F.col("l_orderkey")).withColumnRenamed("o_custkey", "portfolio_id")
    return (
        spread(held, "portfolio_id", "security_id")
        .groupBy("portfolio_id", "security_id")
        .agg(
            F.sum(F.col("l_quantity").cast("long")).cast("decimal(14,4)").alias("shares"),
            F.min("l_extendedprice").cast("decimal(12,4)").alias("average_cost"),
        )
    )


# -- landed raw data and request batches --------------------------------------


@_builds("raw_constituents")
def _raw_constituents(t):
    listed = (
        t.base("supplier")
        .join(t.base("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.base("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("ordinal"),
            F.concat(F.lit(" S."), _padded("s_suppkey"), F.lit(" ")).alias("symbol"),
            F.col("s_name").alias("security"),
            F.when(F.col("s_suppkey") % 9 != 8, F.col("r_name")).alias("sector"),
            F.col("n_name").alias("sub_industry"),
        )
    )
    repeated = t.base("supplier").filter(F.col("s_suppkey") % 7 == 0).select(
        (F.lit(1_000_000) + F.col("s_suppkey")).alias("ordinal"),
        F.concat(F.lit("S."), _padded("s_suppkey")).alias("symbol"),
        F.lit("Duplicate").alias("security"),
        F.lit("DUP").alias("sector"),
        F.lit("DUP").alias("sub_industry"),
    )
    return listed.unionByName(repeated)


@_builds("raw_price")
def _raw_price(t):
    price = t["Price"]
    volume = F.col("volume")
    fields = ("open", "high", "low")
    known = F.struct(
        _ticker("security_id").alias("symbol"),
        "trade_date",
        *fields,
        F.when(volume % 23 != 0, F.col("close")).alias("close"),
        F.when(volume % 19 != 0, volume.cast("double")).alias("volume"),
    )
    stray = F.struct(
        F.lit("UNKNOWN").alias("symbol"), "trade_date", *fields, "close", volume.cast("double").alias("volume")
    )
    # One pass over the prices: those of the first security are listed a second time.
    both = F.when(F.col("security_id") == 0, F.array(known, stray)).otherwise(F.array(known))
    return price.filter(F.col("security_id") != BASKET_ID).select(F.inline(both))


@_builds("raw_price_wide")
def _raw_price_wide(t):
    """Every price, eight securities side by side per row."""

    def cell(slot, field):
        return F.max(F.when(F.pmod("security_id", F.lit(WIDE_SLOTS)) == slot, F.col(field))).alias(f"P{slot}_{field}")

    block = F.floor(F.col("security_id") / WIDE_SLOTS).alias("block")
    cells = [cell(slot, field) for slot in range(WIDE_SLOTS) for field in ("close", "volume")]
    return t["Price"].groupBy(block, "trade_date").agg(*cells)


@_builds("raw_info")
def _raw_info(t):
    key = F.col("s_suppkey")
    return t.base("supplier").select(
        _ticker("s_suppkey").alias("symbol"),
        F.when(key % 6 != 5, key * 1_000_003).alias("market_cap"),
        F.when(key % 5 == 4, F.lit(0.0)).otherwise(key.cast("double") + 0.125).alias("trailing_pe"),
        F.when(key % 8 != 7, key.cast("double") * 0.5).alias("trailing_eps"),
        (key % 3).cast("double").alias("beta"),
    )


@_builds("raw_action")
def _raw_action(t):
    return t["Corporate_Action"].select(
        _ticker("security_id").alias("symbol"),
        "action_date",
        F.when(F.col("action_type") == "dividend", "dividend").otherwise("split").alias("kind"),
        F.col("amount").alias("value"),
    )


@_builds("raw_chain")
def _raw_chain(t):
    return t["Option_Contract"].select(
        "underlying_id",
        "expiration_date",
        "option_type",
        F.col("strike_price").alias("strike"),
        "implied_volatility",
        F.when(F.col("option_id") % 4 != 3, F.col("open_interest")).alias("open_interest"),
    )


@_builds("option_target")
def _option_target(t):
    """Contracts to be priced off the chain; some expire on a date it does not list."""
    expiry = F.when(F.col("option_id") % 9 == 8, F.lit("2003-01-17").cast("date")).otherwise(F.col("expiration_date"))
    return t["Option_Contract"].select(
        "option_id",
        "underlying_id",
        expiry.alias("expiration_date"),
        (F.col("strike_price") + F.lit("3.37").cast("decimal(3,2)")).cast("decimal(12,2)").alias("strike"),
        "option_type",
        F.lit("0.25").cast("decimal(8,4)").alias("iv_fallback"),
        F.lit(11).alias("oi_fallback"),
    )


@_builds("raw_etf_info")
def _raw_etf_info(t):
    """Fund metadata with every kind of gap, one fund per supplier."""
    key = F.col("s_suppkey")
    return t.base("supplier").select(
        _ticker("s_suppkey").alias("symbol"),
        F.when(key % 3 == 0, "").when(key % 3 == 1, F.concat(F.lit("Long "), F.col("s_name"))).alias("long_name"),
        F.when(key % 4 == 0, F.concat(F.lit("Short "), F.col("s_name"))).when(key % 4 == 1, "").alias("short_name"),
        F.when(key % 5 == 0, F.lit(0.0)).when(key % 5 < 3, key / F.lit(100000.0)).alias("expense_a"),
        F.when(key % 2 == 0, key / F.lit(50000.0)).alias("expense_b"),
    )


@_builds("raw_holding")
def _raw_holding(t):
    """Holdings named by ticker; every eighth security is one nobody lists."""
    ticker = F.when(F.col("security_id") % 8 == 7, F.concat(F.lit("Q"), F.col("security_id").cast("string"))).otherwise(
        _ticker("security_id")
    )
    return t["Holding"].select("portfolio_id", ticker.alias("ticker"), "shares", "average_cost")


@_builds("pf_spec")
def _pf_spec(t):
    key = F.col("c_custkey")
    return t.base("customer").select(
        key.alias("spec_id"),
        F.concat(
            F.lit("s"), F.lpad((key % 10).cast("string"), 5, "0"), F.lit(":"), (1 + key % 50).cast("string"),
            F.lit(":150.5, SPY :5,BAD,ZZZ:3:1,S00001:-2,:4,S00002:10abc:7,PRM:2:40"),
            F.when(key % 3 == 0, ",SPY:8:500").otherwise(""),
        ).alias("spec"),
    )


@_builds("pf_save_request")
def _pf_save_request(t):
    key = F.col("c_custkey")
    user = F.concat(F.lit("u:"), (key % 10).cast("string"))
    return t.base("customer").select(
        key.alias("request_id"),
        F.when(key % 4 == 1, "nobody").otherwise(user).alias("owner"),
        F.when(key % 5 == 0, "  ").otherwise(F.concat(F.lit("Plan "), key.cast("string"))).alias("name"),
        F.when(key % 6 == 0, "BAD,:1:2").otherwise("S00001:4:-3,SPY:2:500,ZZZ:1").alias("holdings"),
        F.when(key % 2 == 0, key).otherwise(F.lit(0)).alias("portfolio_id"),
    )
