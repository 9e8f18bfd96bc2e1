"""Constraint checks: each returns the violations as rows, none for clean tables.

A violation is (table_name, rule, key, n_rows). Bulk loads do not validate, so
these jobs take the place of declared constraints. Keys are counted before any
join, which leaves one row per key to shuffle however hot a key is.

Rules are SQL texts: all of them together are over a thousand operators, and
each operator of a column made in Python costs several calls to the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.keys import spread
from marketloom.schema import TABLES, Table, dependencies

Tables = Mapping[str, DataFrame]
SUBTYPES = {"stock": "Stock", "etf": "ETF", "option": "Option_Contract"}


def key_text(columns: Iterable[str]) -> Column:
    """Key values joined by '|', NULL shown as the word."""
    return F.expr(_key_sql(columns))


def _key_sql(columns: Iterable[str]) -> str:
    return f"concat_ws('|', {', '.join(f'coalesce(string(`{c}`), "NULL")' for c in columns)})"


def _report(rows: DataFrame, table: str, rule: str, key: Iterable[str], n: str = "1") -> DataFrame:
    return rows.selectExpr(
        f"'{table}' AS table_name", f"'{rule}' AS rule", f"{_key_sql(key)} AS key", f"bigint({n}) AS n_rows")


def _union(reports: list[DataFrame]) -> DataFrame:
    """Reports have the same columns in the same order."""
    return reduce(DataFrame.union, reports)


def _present(tables: Tables, only: Iterable[str] | None) -> list[Table]:
    names = set(only) if only is not None else set(TABLES)
    return [t for t in TABLES.values() if t.name in names and t.name in tables]


def _any(tests: Iterable[str]) -> str:
    return " OR ".join(f"({t})" for t in tests)


def _any_null(columns) -> str:
    return _any(f"`{c}` IS NULL" for c in columns)


def _key_sets(table: Table) -> list[tuple[str, ...]]:
    """The column sets that some rule of the table groups by, each once."""
    return list(dict.fromkeys([table.key, *table.unique, *[left for left, _ in dependencies(table)]]))


def _differing(column: str) -> tuple[list[str], str]:
    """Aggregates of a dependent column, and the test that it has several values (NULL is one).

    Smallest and largest value and a count combine before the shuffle, and stay on
    the hash path for the fixed-width columns that facts have.
    """
    low, high, given = f"__low_{column}", f"__high_{column}", f"__given_{column}"
    aggregates = [f"min(`{column}`) AS {low}", f"max(`{column}`) AS {high}", f"count(`{column}`) AS {given}"]
    return aggregates, f"coalesce({low} <> {high}, false) OR ({given} > 0 AND {given} < __n)"


def _key_rules(tables: Tables, only, kinds: Iterable[str]) -> DataFrame:
    """Rules that look at all rows of a key, in one aggregation per table and key set."""
    found = []
    for t in _present(tables, only):
        for columns in _key_sets(t):
            aggregates, rules = ["count(*) AS __n"], []
            if "primary" in kinds and columns == t.key:
                rules.append(("primary key", f"__n > 1 OR {_any_null(columns)}"))
            if "unique" in kinds and columns in t.unique:
                rules.append((f"unique {','.join(columns)}", f"__n > 1 AND NOT ({_any_null(columns)})"))
            for left, right in dependencies(t) if "dependency" in kinds else ():
                if left == columns:
                    parts = [_differing(c) for c in right]
                    aggregates += [a for more, _ in parts for a in more]
                    rules.append((f"{','.join(left)} -> {','.join(right)}", _any(d for _, d in parts)))
            if rules:
                # Tables with a key of several columns are the large ones; many tasks over a few rows of the others would only cost time.
                rows = spread(tables[t.name], *columns) if len(columns) > 1 else tables[t.name]
                grouped = rows.groupBy(*columns).agg(*map(F.expr, aggregates))
                found.append(_broken(grouped, t, rules, columns, "__n"))
    return _union(found)


def primary_keys(tables: Tables, only=None) -> DataFrame:
    """Keys that are missing or held by several rows."""
    return _key_rules(tables, only, ["primary"])


def unique_sets(tables: Tables, only=None) -> DataFrame:
    """Values of a unique set held by several rows; rows with a NULL in it are free."""
    return _key_rules(tables, only, ["unique"])


def functional_dependencies(tables: Tables, only=None) -> DataFrame:
    """Determinants that occur with more than one value of their dependents, with their number of rows."""
    return _key_rules(tables, only, ["dependency"])


def foreign_keys(tables: Tables, only=None) -> DataFrame:
    """References to a parent that does not exist, with the number of rows holding them."""
    found = []
    for t in _present(tables, only):
        for ref in t.refs:
            parent_key = TABLES[ref.parent].key[0]
            given = tables[t.name].filter(f"`{ref.column}` IS NOT NULL").selectExpr(f"`{ref.column}` AS ref")
            held = given.groupBy("ref").agg(F.expr("count(*) AS n"))
            parents = tables[ref.parent].selectExpr(f"`{parent_key}` AS ref")
            orphans = held.join(parents, "ref", "left_anti")
            found.append(_report(orphans, t.name, f"{ref.column} -> {ref.parent}", ["ref"], "n"))
    return _union(found)


def _broken(rows: DataFrame, table: Table, rules: list[tuple[str, str]], key: Iterable[str], n: str) -> DataFrame:
    """One row per row of ``rows`` and rule that it breaks."""
    names = ", ".join(f"CASE WHEN {test} THEN '{rule}' END" for rule, test in rules)
    return rows.filter(_any(test for _, test in rules)).selectExpr(
        f"'{table.name}' AS table_name", f"explode(filter(array({names}), r -> r IS NOT NULL)) AS rule",
        f"{_key_sql(key)} AS key", f"bigint({n}) AS n_rows"
    )


def _minimum_rules(t: Table) -> list[tuple[str, str]]:
    out = []
    for c in t.cols:
        if c.minimum is not None:
            sign, under = (">", "<=") if c.exclusive else (">=", "<")
            out.append((f"{c.name} {sign} {c.minimum}", f"coalesce(`{c.name}` {under} {c.minimum}, false)"))
    return out


def _required_rules(t: Table) -> list[tuple[str, str]]:
    return [(f"{c.name} not null", f"`{c.name}` IS NULL") for c in t.cols if c.required]


def _set_rules(t: Table) -> list[tuple[str, str]]:
    return [
        (f"{c.name} in set", f"coalesce(`{c.name}` NOT IN ({', '.join(map(repr, c.allowed))}), false)")
        for c in t.cols if c.allowed
    ]


def _length_rules(t: Table) -> list[tuple[str, str]]:
    return [
        (f"{c.name} length <= {c.max_chars}", f"coalesce(char_length(`{c.name}`) > {c.max_chars}, false)")
        for c in t.cols
        if c.max_chars
    ]


def _row_rules(tables: Tables, only, *rules_of) -> DataFrame:
    """Rows breaking rules about single rows: one scan of a table for all of them."""
    found = []
    for t in _present(tables, only):
        rules = [rule for given in rules_of for rule in given(t)]
        if rules:
            broken = _broken(tables[t.name], t, rules, t.key, "1")
            found.append(broken.groupBy("table_name", "rule", "key").agg(F.expr("count(*) AS n_rows")))
    return _union(found)


def value_checks(tables: Tables, only=None) -> DataFrame:
    """Values under their minimum; a missing value passes."""
    return _row_rules(tables, only, _minimum_rules)


def not_null(tables: Tables, only=None) -> DataFrame:
    return _row_rules(tables, only, _required_rules)


def value_sets(tables: Tables, only=None) -> DataFrame:
    """Values outside their closed set."""
    return _row_rules(tables, only, _set_rules)


def text_lengths(tables: Tables, only=None) -> DataFrame:
    return _row_rules(tables, only, _length_rules)


def subtype_agreement(tables: Tables) -> DataFrame:
    """Securities without the row their type calls for, and subtype rows of another type."""
    found = []
    for kind, name in SUBTYPES.items():
        typed = tables["Security"].filter(f"security_type = '{kind}'").select("security_id")
        members = tables[name].select("security_id").distinct()
        for rows, others, rule in (
            (typed, members, f"{kind} has a {name} row"),
            (members, typed, f"{name} row is a {kind}"),
        ):
            lonely = rows.join(others, "security_id", "left_anti")
            found.append(_report(lonely, "Security", rule, ["security_id"]))
    return _union(found)


def all_violations(tables: Tables, only=None) -> DataFrame:
    """Every check, as one report: one pass of a table for its row rules, and one for each key set and reference."""
    found = [
        _key_rules(tables, only, ["primary", "unique", "dependency"]),
        _row_rules(tables, only, _minimum_rules, _required_rules, _set_rules, _length_rules),
    ]
    if any(t.refs for t in _present(tables, only)):
        found.append(foreign_keys(tables, only))
    return _union(found if only is not None else [*found, subtype_agreement(tables)])


#: ``all_violations`` as a check for each table. The plan of all of them together has over sixty shuffles,
#: and a session that adapts its plans looks at the whole of it after every one.
EACH_TABLE = (*(partial(all_violations, only=[name]) for name in TABLES), subtype_agreement)
