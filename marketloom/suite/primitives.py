"""Registered relational primitives and scalar functions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions import leading_number, pct_change, ratio, round_half_away, year_before
from marketloom.operators import relational as rel
from marketloom.operators import timeseries as ts
from marketloom.operators.keys import next_id
from marketloom.plans import common
from marketloom.suite.derived_sql import pct, rounded
from marketloom.suite.registry import END, SECTOR, START, TICKER, case

_RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"


def _double(*names):
    return [F.col(n).cast("double").alias(n) for n in names]


@case("op_project_alias", sql=f"""
    SELECT security_id, trade_date, CAST(high - low AS DOUBLE) AS spread, {rounded(pct('close', 'open'), 2)} AS day_move_pct
    FROM Price""")
def _(t):
    return t["Price"].select(
        "security_id", "trade_date", (F.col("high") - F.col("low")).cast("double").alias("spread"),
        round_half_away(pct_change("close", "open"), 2).alias("day_move_pct"),
    )


@case("op_filter_eq", sql=f"SELECT security_id, ticker FROM Security WHERE ticker = '{TICKER}'")
def _(t):
    return t["Security"].filter(F.col("ticker") == F.lit(TICKER)).select("security_id", "ticker")


@case("op_filter_between", sql=f"""
    SELECT security_id, trade_date, volume FROM Price WHERE trade_date {_RANGE}""")
def _(t):
    return t["Price"].filter(common.between("trade_date", START, END)).select("security_id", "trade_date", "volume")


@case("op_filter_in", sql="SELECT security_id, security_type FROM Security WHERE security_type IN ('stock', 'etf')")
def _(t):
    return t["Security"].filter(F.col("security_type").isin("stock", "etf")).select("security_id", "security_type")


@case("op_filter_like", sql="""
    SELECT portfolio_id, owner_name FROM Portfolio WHERE portfolio_name LIKE 'Customer%' AND owner_name NOT LIKE 'u:%'""")
def _(t):
    keep = F.col("portfolio_name").like("Customer%") & ~F.col("owner_name").like("u:%")
    return t["Portfolio"].filter(keep).select("portfolio_id", "owner_name")


@case("op_filter_null", sql="""
    SELECT security_id, snapshot_date, TRUE AS known FROM Financial_Snapshot WHERE pe_ratio IS NOT NULL
    UNION ALL SELECT security_id, snapshot_date, FALSE FROM Financial_Snapshot WHERE pe_ratio IS NULL""")
def _(t):
    rows = t["Financial_Snapshot"].select("security_id", "snapshot_date", "pe_ratio")
    known = rows.filter(F.col("pe_ratio").isNotNull()).withColumn("known", F.lit(True))
    return known.unionByName(rows.filter(F.col("pe_ratio").isNull()).withColumn("known", F.lit(False))).drop("pe_ratio")


@case("op_filter_or_all", sql=f"""
    SELECT 'ALL' AS asked, industry_name FROM Industry
    UNION ALL SELECT '{SECTOR}', industry_name FROM Industry JOIN Sector USING (sector_id) WHERE sector_name = '{SECTOR}'""")
def _(t):
    rows = t["Industry"].join(t["Sector"], "sector_id")

    def asked(value):
        return rows.filter(rel.optional_equals("sector_name", value)).select(F.lit(value).alias("asked"), "industry_name")

    return asked("ALL").unionByName(asked(SECTOR))


@case("op_having", sql="""
    SELECT security_id, CAST(SUM(amount) AS DOUBLE) AS paid FROM Corporate_Action WHERE action_type = 'dividend'
    GROUP BY security_id HAVING SUM(amount) > 3""")
def _(t):
    paid = t["Corporate_Action"].filter(F.col("action_type") == "dividend").groupBy("security_id")
    return paid.agg(F.sum("amount").alias("paid")).filter(F.col("paid") > 3).withColumn("paid", F.col("paid").cast("double"))


_CHAIN = """Stock JOIN Company USING (company_id) JOIN Industry USING (industry_id) JOIN Sector USING (sector_id)
    JOIN Security USING (security_id)"""


@case("join_inner_equi", sql=f"SELECT ticker, company_name, industry_name, sector_name FROM {_CHAIN}")
def _(t):
    return common.with_ticker(t, common.stocks(t)).select("ticker", "company_name", "industry_name", "sector_name")


@case("join_left", sql="""
    SELECT ticker, fund_name, company_id FROM Security LEFT JOIN Stock USING (security_id) LEFT JOIN ETF USING (security_id)""")
def _(t):
    return t["Security"].join(t["Stock"], "security_id", "left").join(t["ETF"], "security_id", "left").select(
        "ticker", "fund_name", "company_id"
    )


_ENDS = f"""ends AS (
        SELECT security_id, ARG_MIN(close, trade_date) FILTER (WHERE trade_date >= DATE '{START}') AS first_close,
               ARG_MAX(close, trade_date) FILTER (WHERE trade_date <= DATE '{END}') AS last_close
        FROM Price GROUP BY security_id)"""


@case("join_cross_const", sql=f"""WITH {_ENDS},
    gains AS (SELECT security_id, {pct('last_close', 'first_close')} AS gain FROM ends
              WHERE first_close IS NOT NULL AND last_close IS NOT NULL),
    bench AS (SELECT gain AS spy FROM gains JOIN Security USING (security_id) WHERE ticker = 'SPY')
    SELECT security_id, {rounded('gain', 4)} AS total_return, {rounded('spy', 4)} AS bench_return FROM gains, bench""")
def _(t):
    rows = common.with_benchmark(t, common.stock_returns(t["Price"], START, END), START, END)
    return rows.select("security_id", *[round_half_away(c, 4).alias(c) for c in ("total_return", "bench_return")])


_PREVIOUS = """
    SELECT security_id, trade_date, CAST(LAG(close) OVER (PARTITION BY security_id ORDER BY trade_date) AS DOUBLE) AS prev_close
    FROM Price"""


@case("join_self_prev", sql=f"SELECT * FROM ({_PREVIOUS}) AS lagged WHERE prev_close IS NOT NULL")
def _(t):
    rows = ts.with_previous(t["Price"], "close", ["security_id"], ["trade_date"], "prev_close")
    return rows.filter(F.col("prev_close").isNotNull()).select("security_id", "trade_date", *_double("prev_close"))


@case("join_derived", sql="""
    SELECT ticker, n_days, top_volume FROM Security JOIN
        (SELECT security_id, COUNT(*) AS n_days, MAX(volume) AS top_volume FROM Price GROUP BY security_id) AS totals
        USING (security_id)""")
def _(t):
    totals = t["Price"].groupBy("security_id").agg(F.count("*").alias("n_days"), F.max("volume").alias("top_volume"))
    return common.with_ticker(t, totals).select("ticker", "n_days", "top_volume")


def _asof(t, leg):
    rows = ts.join_asof(t["Corporate_Action"], t["Price"], [leg], by=["security_id"], left_on="action_date",
                        right_on="trade_date", value="close")
    return rows.select("security_id", "action_date", "action_type", *_double("amount", leg.name))


_ASOF = """SELECT a.security_id, a.action_date, a.action_type, CAST(a.amount AS DOUBLE) AS amount, CAST(p.close AS DOUBLE) AS found
    FROM (SELECT *, action_date {shift} AS at FROM Corporate_Action) a
    ASOF LEFT JOIN Price p ON a.security_id = p.security_id AND a.at {side} p.trade_date"""


@case("join_asof_backward", sql=_ASOF.format(shift="- 7", side=">="))
def _(t):
    return _asof(t, ts.Leg("found", "backward", -7))


@case("join_asof_forward", sql=_ASOF.format(shift="+ 7", side="<="))
def _(t):
    return _asof(t, ts.Leg("found", "forward", 7))


@case("join_semi", sql="SELECT ticker FROM Security WHERE security_id IN (SELECT security_id FROM Holding)")
def _(t):
    return t["Security"].join(t["Holding"], "security_id", "left_semi").select("ticker")


@case("join_anti", sql="SELECT ticker FROM Security s WHERE NOT EXISTS (SELECT 1 FROM Price p WHERE p.security_id = s.security_id)")
def _(t):
    return t["Security"].join(t["Price"].select("security_id").distinct(), "security_id", "left_anti").select("ticker")


@case("latest_per_key", sql="""
    SELECT security_id, snapshot_date, market_cap, CAST(eps AS DOUBLE) AS eps FROM Financial_Snapshot
    QUALIFY ROW_NUMBER() OVER (PARTITION BY security_id ORDER BY snapshot_date DESC) = 1""")
def _(t):
    rows = ts.latest_per_key(t["Financial_Snapshot"], "security_id", "snapshot_date", ["market_cap", "eps"])
    return rows.withColumn("eps", F.col("eps").cast("double"))


@case("first_last_in_range", sql=f"""WITH {_ENDS}
    SELECT security_id, CAST(first_close AS DOUBLE) AS first_close, CAST(last_close AS DOUBLE) AS last_close
    FROM ends WHERE first_close IS NOT NULL AND last_close IS NOT NULL""")
def _(t):
    return ts.endpoints_in_range(t["Price"], START, END).select("security_id", *_double("first_close", "last_close"))


@case("agg_basic", sql=f"""
    SELECT security_id, COUNT(*) AS n, COUNT(eps) AS n_eps, CAST(SUM(eps) AS DOUBLE) AS total,
           {rounded('CAST(SUM(eps) AS DOUBLE) / COUNT(eps)', 6)} AS mean, CAST(MIN(eps) AS DOUBLE) AS least,
           CAST(MAX(eps) AS DOUBLE) AS most
    FROM Financial_Snapshot GROUP BY security_id""")
def _(t):
    eps = F.col("eps")
    return t["Financial_Snapshot"].groupBy("security_id").agg(
        F.count("*").alias("n"), F.count(eps).alias("n_eps"), F.sum(eps).cast("double").alias("total"),
        round_half_away(ratio(F.sum(eps), F.count(eps)), 6).alias("mean"),
        F.min(eps).cast("double").alias("least"), F.max(eps).cast("double").alias("most"),
    )


@case("agg_count_distinct", sql="""
    SELECT trade_date, COUNT(DISTINCT volume) AS volumes FROM Price GROUP BY trade_date""")
def _(t):
    return t["Price"].groupBy("trade_date").agg(F.count_distinct("volume").alias("volumes"))


@case("agg_stddev", sql=f"""
    SELECT security_id, {rounded('STDDEV_POP(CAST(close AS DOUBLE))', 2)} AS pop,
           {rounded('STDDEV_SAMP(CAST(close AS DOUBLE))', 2)} AS samp
    FROM Price GROUP BY security_id""")
def _(t):
    close = F.col("close").cast("double")
    return t["Price"].groupBy("security_id").agg(
        round_half_away(F.stddev_pop(close), 2).alias("pop"), round_half_away(F.stddev_samp(close), 2).alias("samp")
    )


@case("agg_conditional", sql=f"""
    SELECT security_id, CAST(SUM(CASE WHEN close > open THEN 1 ELSE 0 END) AS BIGINT) AS up_days,
           {rounded('CAST(SUM(CASE WHEN close > open THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100', 1)} AS pct_up
    FROM Price GROUP BY security_id""")
def _(t):
    up = F.count_if(F.col("close") > F.col("open"))
    return t["Price"].groupBy("security_id").agg(
        up.alias("up_days"), round_half_away(ratio(up, F.count("*")) * F.lit(100.0), 1).alias("pct_up")
    )


_SIZE = "CASE WHEN volume >= 60 THEN 'heavy' WHEN volume >= 30 THEN 'middling' ELSE 'light' END"


@case("agg_group_expr", sql=f"SELECT {_SIZE} AS size, COUNT(*) AS days FROM Price GROUP BY 1")
def _(t):
    volume = F.col("volume")
    size = F.when(volume >= 60, "heavy").when(volume >= 30, "middling").otherwise("light")
    return t["Price"].groupBy(size.alias("size")).agg(F.count("*").alias("days"))


@case("agg_scalar_correlated", sql="""
    SELECT f.security_id, f.snapshot_date,
           (SELECT COUNT(*) FROM Financial_Snapshot g WHERE g.security_id = f.security_id) AS snapshots
    FROM Financial_Snapshot f""")
def _(t):
    counts = t["Financial_Snapshot"].groupBy("security_id").agg(F.count("*").alias("snapshots"))
    return t["Financial_Snapshot"].select("security_id", "snapshot_date").join(counts, "security_id")


@case("win_lag", sql=_PREVIOUS)
def _(t):
    rows = ts.with_previous(t["Price"], "close", ["security_id"], ["trade_date"], "prev_close")
    return rows.select("security_id", "trade_date", *_double("prev_close"))


@case("win_rows_stddev", sql=f"""
    SELECT security_id, trade_date, {rounded('''STDDEV_SAMP(CAST(close AS DOUBLE)) OVER (
        PARTITION BY security_id ORDER BY trade_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)''', 2)} AS dev
    FROM Price""")
def _(t):
    rows = t["Price"].withColumn("close", F.col("close").cast("double"))
    # Named before it is rounded: an expression that uses a window thrice evaluates it thrice.
    rows = rows.withColumn("dev", ts.rolling_rows(F.stddev_samp, "close", 30))
    return rows.select("security_id", "trade_date", round_half_away("dev", 2).alias("dev"))


@case("win_rows_sum", sql="""
    SELECT security_id, trade_date, CAST(SUM(CASE WHEN close > open THEN 1 ELSE 0 END) OVER (
        PARTITION BY security_id ORDER BY trade_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS ups
    FROM Price""")
def _(t):
    rows = t["Price"].withColumn("up", F.when(F.col("close") > F.col("open"), 1).otherwise(0))
    return rows.select("security_id", "trade_date", ts.rolling_rows(F.sum, "up", 4).alias("ups"))


@case("win_range_days", sql="""
    SELECT security_id, trade_date, COUNT(*) OVER (
        PARTITION BY security_id ORDER BY trade_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS days
    FROM Price""")
def _(t):
    return t["Price"].select("security_id", "trade_date", ts.rolling_days(F.count, "close", 30).alias("days"))


@case("cte", sql="""
    WITH monthly AS (SELECT security_id, DATE_TRUNC('month', trade_date) AS m, SUM(volume) AS v FROM Price GROUP BY 1, 2),
         best AS (SELECT security_id, MAX(v) AS v FROM monthly GROUP BY 1)
    SELECT security_id, CAST(v AS BIGINT) AS best_month FROM best""")
def _(t):
    monthly = t["Price"].groupBy("security_id", F.trunc("trade_date", "month").alias("m")).agg(F.sum("volume").alias("v"))
    return monthly.groupBy("security_id").agg(F.max("v").alias("best_month"))


@case("op_sort", sql="SELECT action_type, COUNT(*) AS n FROM Corporate_Action GROUP BY action_type ORDER BY MIN(amount) DESC")
def _(t):
    rows = t["Corporate_Action"].groupBy("action_type").agg(F.count("*").alias("n"), F.min("amount").alias("least"))
    return rows.orderBy(F.desc("least"), "action_type").drop("least")


@case("op_topk", sql="""
    SELECT security_id, trade_date, volume FROM Price ORDER BY volume DESC, security_id, trade_date LIMIT 20""")
def _(t):
    rows = t["Price"].select("security_id", "trade_date", "volume")
    return rel.top_k(rows, 20, F.desc("volume"), "security_id", "trade_date")


@case("op_topn_per_key", sql="""
    SELECT security_id, snapshot_date FROM Financial_Snapshot
    QUALIFY ROW_NUMBER() OVER (PARTITION BY security_id ORDER BY snapshot_date DESC) <= 4""")
def _(t):
    rows = t["Financial_Snapshot"].select("security_id", "snapshot_date")
    return rel.top_n_per_key(rows, 4, ["security_id"], F.desc("snapshot_date"))


@case("set_union_all", sql="SELECT security_id FROM Stock UNION ALL SELECT security_id FROM Holding")
def _(t):
    return t["Stock"].select("security_id").unionByName(t["Holding"].select("security_id"))


@case("dml_upsert", sql="""
    SELECT portfolio_id, portfolio_name || ' (renamed)' AS portfolio_name, owner_name FROM Portfolio WHERE owner_name LIKE 'u:%'
    UNION ALL SELECT (SELECT MAX(portfolio_id) + 1 FROM Portfolio) + portfolio_id, portfolio_name, owner_name FROM Portfolio WHERE owner_name LIKE 'u:%'
    UNION ALL SELECT portfolio_id, portfolio_name, owner_name FROM Portfolio WHERE owner_name NOT LIKE 'u:%'""")
def _(t):
    owned = t["Portfolio"].filter(F.col("owner_name").startswith("u:"))
    renamed = owned.withColumn("portfolio_name", F.concat("portfolio_name", F.lit(" (renamed)")))
    added = owned.withColumn("portfolio_id", next_id(t["Portfolio"], "portfolio_id") + F.col("portfolio_id"))
    return rel.upsert(t["Portfolio"], renamed.unionByName(added), ["portfolio_id"])


# -- scalar functions ---------------------------------------------------------------


@case("fn_numeric", sql=f"""
    SELECT security_id, trade_date, {rounded('CAST(close AS DOUBLE) / 7', 2)} AS seventh,
           {rounded('SQRT(CAST(252 AS DOUBLE)) * CAST(close AS DOUBLE)', 2)} AS scaled,
           CAST(close AS DOUBLE) / NULLIF(CAST(volume % 5 AS DOUBLE), 0) AS guarded, ABS(volume - 25) AS off,
           GREATEST(volume, 10) AS clamped, CASE WHEN close > open THEN 'up' WHEN close < open THEN 'down' ELSE 'flat' END AS move,
           COALESCE(NULLIF(volume % 4, 0), -1) AS filled
    FROM Price""")
def _(t):
    close, volume = F.col("close").cast("double"), F.col("volume")
    return t["Price"].select(
        "security_id", "trade_date", round_half_away(close / F.lit(7.0), 2).alias("seventh"),
        round_half_away(F.sqrt(F.lit(252.0)) * close, 2).alias("scaled"), ratio(close, volume % 5).alias("guarded"),
        F.abs(volume - 25).alias("off"), F.greatest(volume, F.lit(10)).alias("clamped"),
        F.when(F.col("close") > F.col("open"), "up").when(F.col("close") < F.col("open"), "down").otherwise("flat").alias("move"),
        F.coalesce(F.nullif(volume % 4, F.lit(0)), F.lit(-1)).alias("filled"),
    )


@case("fn_text", sql=r"""
    SELECT spec_id, UPPER(TRIM(SPLIT_PART(spec, ':', 1))) AS head, LEN(STRING_SPLIT(spec, ',')) AS parts,
           spec LIKE CONCAT('s0000', '%') AS prefixed, STARTS_WITH(spec, 's') AS starts, REPLACE(SUBSTR(spec, 1, 12), ':', '-') AS swapped,
           LPAD(CAST(spec_id AS VARCHAR), 12, '0') AS padded,
           COALESCE(TRY_CAST(TRIM(REGEXP_EXTRACT(SPLIT_PART(spec, ':', 2), '^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?', 0)) AS DOUBLE), 0) AS lead
    FROM pf_spec""")
def _(t):
    spec = F.col("spec")
    return t["pf_spec"].select(
        "spec_id", F.upper(F.trim(F.get(F.split(spec, ":"), 0))).alias("head"),
        F.size(F.split(spec, ",")).cast("long").alias("parts"), F.like(spec, F.concat(F.lit("s0000"), F.lit("%"))).alias("prefixed"),
        spec.startswith("s").alias("starts"), F.replace(F.substring(spec, 1, 12), F.lit(":"), F.lit("-")).alias("swapped"),
        F.lpad(F.col("spec_id").cast("string"), 12, "0").alias("padded"),
        leading_number(F.get(F.split(spec, ":"), 1)).alias("lead"),
    )


@case("fn_date", sql="""
    SELECT DISTINCT trade_date, trade_date - 7 AS week_before, trade_date + 7 AS week_after,
           CAST(trade_date - INTERVAL 1 YEAR AS DATE) AS year_before, CAST(trade_date - INTERVAL 3 YEAR AS DATE) AS three_before,
           STRFTIME(trade_date, '%Y%m%d') AS compact, DAYOFWEEK(trade_date) + 1 AS weekday
    FROM Price""")
def _(t):
    day = F.col("trade_date")
    return t["Price"].select("trade_date").distinct().select(
        "trade_date", F.date_sub(day, 7).alias("week_before"), F.date_add(day, 7).alias("week_after"),
        year_before(day).alias("year_before"), year_before(day, 3).alias("three_before"),
        F.date_format(day, "yyyyMMdd").alias("compact"), F.dayofweek(day).cast("long").alias("weekday"),
    )
