"""Registered cross-sector analyses; ``*_universe`` leaves the sector open."""

from __future__ import annotations

from marketloom.plans import sector as plan
from marketloom.suite.derived_sql import pct, rounded
from marketloom.suite.registry import AS_OF, END, MIN_CAP, MIN_QUARTERS, SECTOR, START, case

_RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"
_ONE = f"sector_name = '{SECTOR}'"
_RANGE_ARGS = {"start": START, "end": END}

_MEMBERS = """members AS (
        SELECT k.security_id, t.ticker, c.company_id, c.company_name,
               i.industry_id, i.industry_name, s.sector_id, s.sector_name
        FROM Stock k
        INNER JOIN Security t ON t.security_id = k.security_id
        INNER JOIN Company c ON c.company_id = k.company_id
        INNER JOIN Industry i ON i.industry_id = c.industry_id
        INNER JOIN Sector s ON s.sector_id = i.sector_id)"""
_LATEST = """newest AS (
        SELECT * FROM Financial_Snapshot
        QUALIFY ROW_NUMBER() OVER (PARTITION BY security_id ORDER BY snapshot_date DESC) = 1),
    valued AS (SELECT * FROM newest JOIN members USING (security_id) WHERE {only})"""


def _avg(column):
    return f"CAST(SUM({column}) AS DOUBLE) / COUNT({column})"


def _both(name, fn, text, sector=SECTOR, **params):
    """Registers the sector form and the open form of one analysis."""

    @case(name, sql=text.format(only=f"sector_name = '{sector}'"))
    def _(tables):
        return fn(tables, sector=sector, **params)

    @case(f"{name}_universe", sql=text.format(only="TRUE"))
    def _(tables):
        return fn(tables, sector=None, **params)


@case("sectors", sql="SELECT sector_name FROM Sector")
def _(tables):
    return plan.sectors(tables)


@case("tickers", sql="""
    SELECT ticker, COALESCE(company_name, fund_name) AS company_name, security_type
    FROM Security LEFT JOIN Stock USING (security_id) LEFT JOIN Company USING (company_id)
         LEFT JOIN ETF USING (security_id)
    WHERE security_type <> 'option'""")
def _(tables):
    return plan.tickers(tables)


_SECTOR_RETURNS = f"""WITH {_MEMBERS},
    ends AS (
        SELECT security_id,
               ARG_MIN(close, trade_date) FILTER (WHERE trade_date >= DATE '{START}') AS opening,
               ARG_MAX(close, trade_date) FILTER (WHERE trade_date <= DATE '{END}') AS closing
        FROM Price GROUP BY security_id),
    gains AS (SELECT security_id, {pct('closing', 'opening')} AS gain FROM ends
              WHERE opening IS NOT NULL AND closing IS NOT NULL),
    bench AS (SELECT gain AS spy FROM gains JOIN Security USING (security_id) WHERE ticker = 'SPY'),
    per_sector AS (SELECT sector_id, sector_name, AVG(gain) AS mean_gain, COUNT(DISTINCT security_id) AS stock_count
                   FROM gains JOIN members USING (security_id) GROUP BY sector_id, sector_name)"""


@case("r1_sector_vs_benchmark", sql=f"""{_SECTOR_RETURNS}
    SELECT sector_name, {rounded('mean_gain', 2)} AS sector_return_pct, {rounded('spy', 2)} AS spy_return_pct,
           {rounded('mean_gain - spy', 2)} AS relative_pct
    FROM per_sector, bench""")
def _(tables):
    return plan.sector_vs_benchmark(tables, **_RANGE_ARGS)


@case("q07_sector_vs_benchmark", sql=f"""{_SECTOR_RETURNS}
    SELECT sector_name, stock_count, {rounded('mean_gain', 2)} AS avg_return_pct, {rounded('spy', 2)} AS spy_return_pct
    FROM per_sector, bench""")
def _(tables):
    return plan.sector_vs_benchmark_counted(tables, **_RANGE_ARGS)


_both("r2_pe_by_industry", plan.pe_by_industry, f"""WITH {_MEMBERS}, {_LATEST}
    SELECT industry_name, {rounded(_avg('pe_ratio'), 2)} AS avg_pe, COUNT(DISTINCT company_id) AS companies
    FROM valued WHERE pe_ratio > 0 GROUP BY industry_id, industry_name""")

_both("q08_pe_by_industry_mincap", plan.pe_by_industry_min_cap, f"""WITH {_MEMBERS}, {_LATEST}
    SELECT industry_name, COUNT(DISTINCT company_id) AS company_count, {rounded(_avg('pe_ratio'), 2)} AS avg_pe_ratio
    FROM valued WHERE pe_ratio IS NOT NULL AND market_cap >= {MIN_CAP} GROUP BY industry_id, industry_name""",
      min_cap=MIN_CAP)

_GROWTH = f"""WITH {_MEMBERS},
    prior AS (
        SELECT company_id, snapshot_date, security_id, eps,
               LAG(eps) OVER (PARTITION BY company_id ORDER BY snapshot_date, security_id) AS before
        FROM Financial_Snapshot JOIN Stock USING (security_id)),
    framed AS (
        SELECT company_id, COUNT(*) FILTER (WHERE eps > before) OVER (
                   PARTITION BY company_id ORDER BY snapshot_date, security_id
                   ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS rises
        FROM prior WHERE before IS NOT NULL),
    best AS (SELECT company_id, MAX(rises) AS top FROM framed GROUP BY company_id)
    SELECT company_name, sector_name, CAST(top AS BIGINT) AS consecutive_qtrs
    FROM best JOIN (SELECT DISTINCT company_id, company_name, sector_name FROM members) USING (company_id)
    WHERE top >= {MIN_QUARTERS} AND {{only}}"""


@case("r3_eps_growth_count", sql=_GROWTH.format(only=_ONE))
def _(tables):
    return plan.eps_growth_count(tables, sector=SECTOR, min_q=MIN_QUARTERS)


@case("r3_eps_growth_count_universe", sql=_GROWTH.format(only="TRUE"))
def _(tables):
    return plan.eps_growth_count(tables, min_q=MIN_QUARTERS)


_both("q09_eps_growth_strict", plan.eps_growth_strict, f"""WITH {_MEMBERS},
    numbered AS (
        SELECT security_id, eps,
               LEAD(eps) OVER back AS before, ROW_NUMBER() OVER back AS age, COUNT(*) OVER (PARTITION BY security_id) AS n
        FROM Financial_Snapshot WINDOW back AS (PARTITION BY security_id ORDER BY snapshot_date DESC)),
    stalled AS (SELECT DISTINCT security_id FROM numbered WHERE age <= 4 AND eps <= before),
    long_enough AS (SELECT DISTINCT security_id FROM numbered WHERE n >= 5)
    SELECT company_name, ticker FROM members JOIN long_enough USING (security_id)
         ANTI JOIN stalled USING (security_id)
    WHERE {{only}}""", sector="ASIA")

_both("r4_top_volatile", plan.top_volatile, f"""WITH {_MEMBERS},
    moved AS (
        SELECT security_id, CAST(close - LAG(close) OVER days AS DOUBLE)
                            / NULLIF(CAST(LAG(close) OVER days AS DOUBLE), 0) AS ret
        FROM Price WHERE trade_date {_RANGE} WINDOW days AS (PARTITION BY security_id ORDER BY trade_date))
    SELECT ticker, company_name, {rounded('STDDEV_SAMP(ret) * SQRT(CAST(252 AS DOUBLE)) * 100', 2)} AS ann_vol_pct
    FROM moved JOIN members USING (security_id) WHERE ret IS NOT NULL AND {{only}}
    GROUP BY ticker, company_name ORDER BY ann_vol_pct DESC NULLS LAST, ticker, company_name LIMIT 10""", **_RANGE_ARGS)

_both("q10_top_price_stddev", plan.top_price_stddev, f"""WITH {_MEMBERS}
    SELECT ticker, company_name, price_stddev, trading_days FROM (
        SELECT security_id, ticker, company_name, {rounded('STDDEV_POP(CAST(close AS DOUBLE))', 2)} AS price_stddev,
               COUNT(*) AS trading_days
        FROM Price JOIN members USING (security_id) WHERE trade_date {_RANGE} AND {{only}}
        GROUP BY security_id, ticker, company_name
        ORDER BY price_stddev DESC NULLS LAST, security_id LIMIT 10) AS ranking""", **_RANGE_ARGS)

_MEANS = f"industry_mean AS (SELECT industry_id, {_avg('pe_ratio')} AS mean_pe FROM valued WHERE {{keep}} GROUP BY industry_id)"


@case("r5_below_avg_pe", sql=f"""WITH {_MEMBERS}, {_LATEST.format(only='TRUE')}, {_MEANS.format(keep='pe_ratio > 0')}
    SELECT industry_name, {rounded(_avg('pe_ratio'), 1)} AS avg_pe, COUNT(*) AS total_companies,
           {rounded('CAST(COUNT(*) FILTER (WHERE CAST(pe_ratio AS DOUBLE) < mean_pe) AS DOUBLE) / COUNT(*) * 100', 1)}
               AS pct_below_avg
    FROM valued JOIN industry_mean USING (industry_id) WHERE pe_ratio > 0 GROUP BY industry_id, industry_name""")
def _(tables):
    return plan.below_average_pe(tables)


@case("q11_below_avg_pe", sql=f"""WITH {_MEMBERS}, {_LATEST.format(only='TRUE')},
    {_MEANS.format(keep='pe_ratio IS NOT NULL')},
    counted AS (
        SELECT industry_id, industry_name, COUNT(DISTINCT company_id) AS total_companies,
               COUNT(*) FILTER (WHERE CAST(pe_ratio AS DOUBLE) < mean_pe) AS below_avg_count
        FROM valued JOIN industry_mean USING (industry_id) WHERE pe_ratio IS NOT NULL
        GROUP BY industry_id, industry_name)
    SELECT industry_name, total_companies, below_avg_count,
           {rounded('CAST(below_avg_count AS DOUBLE) / total_companies * 100', 1)} AS pct_below_avg
    FROM counted""")
def _(tables):
    return plan.below_average_pe_distinct(tables)


_YIELD = f"""WITH {_MEMBERS},
    paid AS (
        SELECT security_id, SUM(amount) AS dividends FROM Corporate_Action
        WHERE action_type = 'dividend' AND action_date >= DATE '{AS_OF}' - INTERVAL 1 YEAR
        GROUP BY security_id HAVING SUM(amount) > 0),
    quote AS (SELECT security_id, ARG_MAX(close, trade_date) AS close FROM Price GROUP BY security_id)"""
_YIELD_PCT = rounded("CAST(dividends AS DOUBLE) / NULLIF(CAST(close AS DOUBLE), 0) * 100", 2)

_both("r6_dividend_yield", plan.dividend_yield, f"""{_YIELD}
    SELECT company_name, ticker, {_YIELD_PCT} AS div_yield_pct, {rounded('dividends', 3)} AS total_div_paid,
           {rounded('close', 2)} AS latest_close
    FROM members JOIN paid USING (security_id) JOIN quote USING (security_id)
    WHERE {{only}} ORDER BY div_yield_pct DESC NULLS LAST, security_id LIMIT 15""", as_of=AS_OF)

_both("q12_dividend_yield", plan.dividend_yield_detailed, f"""{_YIELD}, {_LATEST}
    SELECT ticker, company_name, industry_name, {_YIELD_PCT} AS dividend_yield_pct,
           CAST(pe_ratio AS DOUBLE) AS pe_ratio, {rounded('CAST(market_cap AS DOUBLE) / 1e9', 2)} AS market_cap_billions
    FROM valued JOIN paid USING (security_id) JOIN quote USING (security_id)
    ORDER BY dividend_yield_pct DESC NULLS LAST, security_id LIMIT 20""", as_of=AS_OF)


def _tier_sql(tiers, rest):
    return "CASE " + " ".join(f"WHEN market_cap >= {b} THEN '{t}'" for b, t in tiers) + f" ELSE '{rest}' END"


_both("r7_cap_tier_list", plan.cap_tiers, f"""WITH {_MEMBERS}, {_LATEST}
    SELECT company_name, ticker, industry_name, {rounded('CAST(market_cap AS DOUBLE) / 1e9', 1)} AS mkt_cap_b,
           {_tier_sql(plan.FOUR_TIERS, plan.FOUR_TIERS_REST)} AS cap_tier
    FROM valued WHERE market_cap IS NOT NULL""")

_both("q13_cap_tier_distribution", plan.cap_tier_distribution, f"""WITH {_MEMBERS}, {_LATEST}
    SELECT {_tier_sql(plan.FIVE_TIERS, plan.FIVE_TIERS_REST)} AS cap_tier, COUNT(DISTINCT company_id) AS company_count,
           {rounded('CAST(SUM(market_cap) AS DOUBLE) / COUNT(*) / 1e9', 2)} AS avg_mktcap_billions
    FROM valued WHERE market_cap IS NOT NULL GROUP BY 1""")


def _beta_sql(digits, count_name):
    return f"""WITH {_MEMBERS}, {_LATEST}
    SELECT industry_name, {rounded(_avg('beta'), digits)} AS avg_beta, {rounded('MIN(beta)', digits)} AS min_beta,
           {rounded('MAX(beta)', digits)} AS max_beta, COUNT(DISTINCT company_id) AS {count_name}
    FROM valued WHERE beta IS NOT NULL GROUP BY industry_id, industry_name"""


_both("r8_beta_dispersion", plan.beta_dispersion, _beta_sql(3, "companies"))
_both("q14_beta_dispersion", plan.beta_dispersion_fine, _beta_sql(4, "company_count"))

_both("r9_volume_leaders", plan.volume_leaders, f"""WITH {_MEMBERS}
    SELECT ticker, company_name, industry_name, {rounded(_avg('volume'), 0)} AS avg_daily_vol,
           {rounded(_avg('close'), 2)} AS avg_close
    FROM Price JOIN members USING (security_id) WHERE trade_date {_RANGE} AND {{only}}
    GROUP BY ticker, company_name, industry_name
    ORDER BY avg_daily_vol DESC NULLS LAST, ticker, company_name LIMIT 10""", **_RANGE_ARGS)

_both("q15_volume_leaders", plan.volume_leaders_by_security, f"""WITH {_MEMBERS}
    SELECT ticker, company_name, industry_name, avg_daily_volume FROM (
        SELECT security_id, ticker, company_name, industry_name, {rounded(_avg('volume'), 0)} AS avg_daily_volume
        FROM Price JOIN members USING (security_id) WHERE trade_date {_RANGE} AND {{only}}
        GROUP BY security_id, ticker, company_name, industry_name
        ORDER BY avg_daily_volume DESC NULLS LAST, security_id LIMIT 10) AS ranking""", **_RANGE_ARGS)
