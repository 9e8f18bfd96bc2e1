"""Registered data-quality jobs, each on the derived tables plus injected faults."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from marketloom.operators.keys import next_id
from marketloom.quality import changes, constraints
from marketloom.schema import LOAD_ORDER, TABLES, dependencies
from marketloom.sources import files
from marketloom.suite.registry import case


def _key_sql(columns):
    shown = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
    return f"CONCAT_WS('|', {shown})"


def _all(parts):
    return " UNION ALL ".join(parts)


def _sources(**faulty):
    """CTE prefix and the relation each table is read from."""
    prefix = ", ".join(f"bad_{name.lower()} AS ({text})" for name, text in faulty.items())
    named = {n: f"bad_{n.lower()}" if n in faulty else n for n in LOAD_ORDER}
    return (f"WITH {prefix} " if prefix else ""), named


def _with(tables, **faulty):
    return ChainMap(faulty, tables)


# -- keys -------------------------------------------------------------------------

_DOUBLED = """SELECT * FROM Price
    UNION ALL SELECT * FROM Price WHERE security_id % 10 = 0
    UNION ALL SELECT NULL, MAX(trade_date), NULL, NULL, NULL, MAX(close), 0 FROM Price"""


def _doubled(tables):
    price = tables["Price"]
    blank = price.agg(F.max("trade_date").alias("trade_date"), F.max("close").alias("close")).withColumn(
        "volume", F.lit(0).cast("long")
    )
    return price.unionByName(price.filter(F.col("security_id") % 10 == 0)).unionByName(blank, allowMissingColumns=True)


def _key_check(**faulty):
    prefix, source = _sources(**faulty)
    parts = []
    for t in TABLES.values():
        missing = " OR ".join(f"{c} IS NULL" for c in t.key)
        parts.append(f"SELECT '{t.name}' AS table_name, 'primary key' AS rule, {_key_sql(t.key)} AS key, "
                     f"COUNT(*) AS n_rows FROM {source[t.name]} GROUP BY {', '.join(t.key)} "
                     f"HAVING COUNT(*) > 1 OR {missing}")
    return prefix + _all(parts)


@case("dq_primary_key", sql=_key_check(Price=_DOUBLED), with_ids=True)
def _(tables):
    return constraints.primary_keys(_with(tables, Price=_doubled(tables)))


_TWINS = """SELECT * FROM Security
    UNION ALL SELECT security_id + (SELECT MAX(security_id) + 1 FROM Security), ticker, exchange_id, currency, security_type
    FROM Security WHERE security_type = 'stock'"""
_TWIN_SNAPS = """SELECT * FROM Financial_Snapshot
    UNION ALL SELECT snapshot_id + (SELECT MAX(snapshot_id) + 1 FROM Financial_Snapshot), security_id, snapshot_date, market_cap, pe_ratio, eps, beta
    FROM Financial_Snapshot WHERE pe_ratio IS NULL"""


def _unique_check(**faulty):
    prefix, source = _sources(**faulty)
    parts = []
    for t in TABLES.values():
        for u in t.unique:
            given = " AND ".join(f"{c} IS NOT NULL" for c in u)
            parts.append(f"SELECT '{t.name}' AS table_name, 'unique {','.join(u)}' AS rule, {_key_sql(u)} AS key, "
                         f"COUNT(*) AS n_rows FROM {source[t.name]} WHERE {given} GROUP BY {', '.join(u)} "
                         f"HAVING COUNT(*) > 1")
    return prefix + _all(parts)


@case("dq_unique", sql=_unique_check(Security=_TWINS, Financial_Snapshot=_TWIN_SNAPS))
def _(tables):
    twins = tables["Security"].filter(F.col("security_type") == "stock").withColumn(
        "security_id", F.col("security_id") + next_id(tables["Security"], "security_id")
    )
    snaps = tables["Financial_Snapshot"]
    return constraints.unique_sets(_with(
        tables,
        Security=tables["Security"].unionByName(twins),
        Financial_Snapshot=snaps.unionByName(snaps.filter(F.col("pe_ratio").isNull())),
    ))


_SHIFTED = "SELECT portfolio_id, security_id + 5 AS security_id, shares, average_cost FROM Holding"


def _reference_check(**faulty):
    prefix, source = _sources(**faulty)
    parts = []
    for t in TABLES.values():
        for r in t.refs:
            parent = TABLES[r.parent]
            parts.append(f"SELECT '{t.name}' AS table_name, '{r.column} -> {r.parent}' AS rule, "
                         f"{_key_sql([r.column])} AS key, COUNT(*) AS n_rows FROM {source[t.name]} x "
                         f"WHERE {r.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {r.parent} y "
                         f"WHERE y.{parent.key[0]} = x.{r.column}) GROUP BY {r.column}")
    return prefix + _all(parts)


@case("dq_foreign_key", sql=_reference_check(Holding=_SHIFTED))
def _(tables):
    shifted = tables["Holding"].withColumn("security_id", F.col("security_id") + 5)
    return constraints.foreign_keys(_with(tables, Holding=shifted))


# -- values -----------------------------------------------------------------------


def _row_check(faulty, rules_of):
    prefix, source = _sources(**faulty)
    parts = []
    for t in TABLES.values():
        for rule, broken in rules_of(t):
            parts.append(f"SELECT '{t.name}' AS table_name, '{rule}' AS rule, {_key_sql(t.key)} AS key, "
                         f"COUNT(*) AS n_rows FROM {source[t.name]} WHERE {broken} GROUP BY {', '.join(t.key)}")
    return prefix + _all(parts)


def _minimum_rules(t):
    for c in t.cols:
        if c.minimum is not None:
            sign, broken = (">", "<=") if c.exclusive else (">=", "<")
            yield f"{c.name} {sign} {c.minimum}", f"{c.name} {broken} {c.minimum}"


def _required_rules(t):
    return [(f"{c.name} not null", f"{c.name} IS NULL") for c in t.cols if c.required]


def _set_rules(t):
    return [(f"{c.name} in set", f"{c.name} NOT IN {c.allowed}") for c in t.cols if c.allowed]


def _length_rules(t):
    return [(f"{c.name} length <= {c.max_chars}", f"LENGTH({c.name}) > {c.max_chars}") for c in t.cols if c.max_chars]


@case("dq_check", sql=_row_check(
    {
        "Holding": "SELECT portfolio_id, security_id, CASE WHEN portfolio_id % 10 = 0 THEN -shares ELSE shares END "
                   "AS shares, average_cost FROM Holding",
        "Price": "SELECT security_id, trade_date, open, high, low, close, "
                 "CASE WHEN volume % 3 <> 0 THEN volume END AS volume FROM Price",
    },
    _minimum_rules,
))
def _(tables):
    shares, volume = F.col("shares"), F.col("volume")
    return constraints.value_checks(_with(
        tables,
        Holding=tables["Holding"].withColumn(
            "shares", F.when(F.col("portfolio_id") % 10 == 0, -shares).otherwise(shares)
        ),
        Price=tables["Price"].withColumn("volume", F.when(volume % 3 != 0, volume)),
    ))


@case("dq_not_null", sql=_row_check(
    {"Price": "SELECT security_id, trade_date, open, high, low, "
              "CASE WHEN volume % 23 <> 0 THEN close END AS close, volume FROM Price"},
    _required_rules,
), with_ids=True)
def _(tables):
    gaps = F.when(F.col("volume") % 23 != 0, F.col("close"))
    return constraints.not_null(_with(tables, Price=tables["Price"].withColumn("close", gaps)))


@case("dq_enum", sql=_row_check(
    {"Corporate_Action": "SELECT action_id, security_id, action_date, CASE WHEN action_id % 10 = 0 THEN 'merger' "
                         "ELSE action_type END AS action_type, amount FROM Corporate_Action"},
    _set_rules,
), with_ids=True)
def _(tables):
    kind = F.when(F.col("action_id") % 10 == 0, "merger").otherwise(F.col("action_type"))
    return constraints.value_sets(_with(
        tables, Corporate_Action=tables["Corporate_Action"].withColumn("action_type", kind)
    ))


@case("dq_varchar_length", sql=_row_check(
    {"Security": "SELECT security_id, CASE WHEN security_type = 'stock' THEN REPEAT(ticker, 4) ELSE ticker END AS ticker,"
                 " exchange_id, currency, security_type FROM Security"},
    _length_rules,
))
def _(tables):
    long_name = F.when(F.col("security_type") == "stock", F.repeat("ticker", F.lit(4))).otherwise(F.col("ticker"))
    return constraints.text_lengths(_with(tables, Security=tables["Security"].withColumn("ticker", long_name)))


_MISTYPED = """SELECT security_id, ticker, exchange_id, currency,
    CASE WHEN security_type = 'etf' THEN 'stock' ELSE security_type END AS security_type FROM Security"""


def _subtype_check(**faulty):
    prefix, source = _sources(**faulty)
    parts = []
    for kind, name in constraints.SUBTYPES.items():
        typed = f"SELECT security_id FROM {source['Security']} WHERE security_type = '{kind}'"
        member = f"SELECT security_id FROM {name}"
        for rows, others, rule in ((typed, member, f"{kind} has a {name} row"), (member, typed, f"{name} row is a {kind}")):
            parts.append(f"SELECT 'Security' AS table_name, '{rule}' AS rule, CAST(security_id AS VARCHAR) AS key, "
                         f"CAST(1 AS BIGINT) AS n_rows FROM (({rows}) EXCEPT ({others})) AS lonely")
    return prefix + _all(parts)


@case("dq_isa", sql=_subtype_check(Security=_MISTYPED))
def _(tables):
    kind = F.when(F.col("security_type") == "etf", "stock").otherwise(F.col("security_type"))
    return constraints.subtype_agreement(_with(tables, Security=tables["Security"].withColumn("security_type", kind)))


_MOVED = """SELECT * FROM Industry
    UNION ALL SELECT industry_id, industry_name, (sector_id + 1) % 5 FROM Industry WHERE industry_id % 5 = 0"""


def _dependency_check(**faulty):
    prefix, source = _sources(**faulty)
    parts = []
    for t in TABLES.values():
        for left, right in dependencies(t):
            parts.append(f"SELECT '{t.name}' AS table_name, '{','.join(left)} -> {','.join(right)}' AS rule, "
                         f"{_key_sql(left)} AS key, CAST(SUM(n) AS BIGINT) AS n_rows "
                         f"FROM (SELECT {', '.join(left + right)}, COUNT(*) AS n FROM {source[t.name]} GROUP BY ALL) AS pairs "
                         f"GROUP BY {', '.join(left)} HAVING COUNT(*) > 1")
    return prefix + _all(parts)


@case("dq_functional_dependency", sql=_dependency_check(Industry=_MOVED), with_ids=True)
def _(tables):
    rows = tables["Industry"]
    moved = rows.filter(F.col("industry_id") % 5 == 0).withColumn("sector_id", (F.col("sector_id") + 1) % 5)
    return constraints.functional_dependencies(_with(tables, Industry=rows.unionByName(moved)))




_EVERY_CHECK = _all([
    _key_check(), _unique_check(), _reference_check(), _row_check({}, _minimum_rules), _row_check({}, _required_rules),
    _row_check({}, _set_rules), _row_check({}, _length_rules), _subtype_check(), _dependency_check(),
])


@case("dq_all_clean", sql=f"SELECT 'violations' AS report, COUNT(*) AS n FROM ({_EVERY_CHECK}) AS found", with_ids=True)
def _(tables):
    """The derived tables break no rule: the count of violations over all checks is 0."""
    found = constraints.all_violations(tables)
    return found.agg(F.lit("violations").alias("report"), F.count("*").alias("n"))


# -- defaults and changes -----------------------------------------------------------

_FILLED = {"Company": ("company_id", "country", "'US'"), "Security": ("security_id", "currency", "'USD'"),
           "Option_Contract": ("option_id", "open_interest", "'0'")}


@case("dq_default", sql=_all(
    [f"SELECT '{n}' AS table_name, CAST({k} AS VARCHAR) AS key, {v} AS filled FROM {n}" for n, (k, _, v) in _FILLED.items()]
    + ["SELECT 'Price' AS table_name, security_id || '|' || trade_date AS key, '0' AS filled FROM Price"]
))
def _(tables):
    report = None
    for name, column in (("Company", "country"), ("Security", "currency"),
                         ("Option_Contract", "open_interest"), ("Price", "volume")):
        rows = files.with_defaults(tables[name].drop(column), name).select(
            F.lit(name).alias("table_name"),
            constraints.key_text(TABLES[name].key).alias("key"),
            F.col(column).cast("string").alias("filled"),
        )
        report = rows if report is None else report.unionByName(rows)
    return report


@case("dq_auto_increment", sql="""
    SELECT portfolio_id, portfolio_name, owner_name FROM Portfolio
    UNION ALL SELECT CAST((SELECT MAX(portfolio_id) FROM Portfolio) + ROW_NUMBER() OVER (ORDER BY portfolio_id) AS BIGINT),
                     'Copy of ' || portfolio_name, owner_name
    FROM Portfolio WHERE owner_name LIKE 'u:%'""")
def _(tables):
    rows = tables["Portfolio"]
    copies = rows.filter(F.col("owner_name").startswith("u:")).select(
        F.col("portfolio_id").alias("origin"),
        F.concat(F.lit("Copy of "), F.col("portfolio_name")).alias("portfolio_name"),
        "owner_name",
    )
    return changes.append_rows(rows, copies, "portfolio_id", ["origin"])


_DELETED = "SELECT security_id FROM Security WHERE security_type = 'option' OR ticker LIKE '%7'"
_AFTER = ["Security", "Stock", "ETF", "Option_Contract", "Holding", "Price", "Financial_Snapshot", "Corporate_Action"]


@case("dq_delete_cascade", sql=_all(
    f"SELECT '{n}' AS table_name, {_key_sql(TABLES[n].key)} AS key FROM {n} WHERE security_id NOT IN ({_DELETED})" for n in _AFTER
), with_ids=True)
def _(tables):
    security = tables["Security"]
    gone = security.filter((F.col("security_type") == "option") | F.col("ticker").endswith("7")).select("security_id")
    left = changes.delete_cascade(tables, "Security", gone)
    report = None
    for name in _AFTER:
        line = left[name].select(F.lit(name).alias("table_name"), constraints.key_text(TABLES[name].key).alias("key"))
        report = line if report is None else report.unionByName(line)
    return report


@case("dq_delete_restrict", sql="""
    SELECT industry_id, industry_id IN (SELECT industry_id FROM Company) AS refused
    FROM (SELECT CAST(industry_id AS BIGINT) AS industry_id FROM Industry
          UNION ALL SELECT 1000 + industry_id FROM Industry) AS wanted""")
def _(tables):
    ids = tables["Industry"].select("industry_id")
    wanted = ids.unionByName(ids.select((F.col("industry_id") + 1000).alias("industry_id")))
    allowed, refused = changes.delete_restrict(tables, "Industry", wanted)
    return allowed.withColumn("refused", F.lit(False)).unionByName(refused.withColumn("refused", F.lit(True)))


@case("dq_update_cascade", sql="""
    WITH renames AS (SELECT security_id AS old, security_id + (SELECT MAX(security_id) + 3 FROM Security) AS new FROM Security WHERE security_type <> 'option')
    """ + _all(
    f"SELECT '{n}' AS table_name, COALESCE(new, security_id) AS security_id, COUNT(*) AS n_rows "
    f"FROM {n} LEFT JOIN renames ON old = security_id GROUP BY ALL" for n in _AFTER))
def _(tables):
    renames = tables["Security"].filter(F.col("security_type") != "option").select(
        F.col("security_id").alias("old"), (F.col("security_id") + next_id(tables["Security"], "security_id") + 2).alias("new")
    )
    changed = changes.update_cascade(tables, "Security", renames)
    report = None
    for name in _AFTER:
        line = changed[name].groupBy("security_id").agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "security_id", "n_rows"
        )
        report = line if report is None else report.unionByName(line)
    return report
