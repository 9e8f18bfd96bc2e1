"""Registered queries: a Spark callable and, where SQL can say it, its counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketloom.schema import TABLES
from marketloom.sources.derived import DerivedTables
from marketloom.suite.derived_sql import with_relations

# The parameters the registered queries run with.
TICKER = "S00003"
SECTOR = "EUROPE"
START = "1997-01-01"
END = "1997-12-31"
AS_OF = "2001-11-04"
BENCHMARK = "SPY"
MIN_QUARTERS = 3
MIN_CAP = 1_000_000_000
OWNER = "u:3"
PORTFOLIO = 3


def column_sql(column) -> str:
    """A column cast to its declared type."""
    kind = column.type.simpleString()
    return f"CAST({column.name} AS {({'string': 'varchar', 'int': 'integer'}.get(kind, kind)).upper()})"


def line_sql(table: str) -> str:
    """A row of a table as text, as ``key_text`` of all its columns gives it."""
    return "CONCAT_WS('|', " + ", ".join(f"COALESCE(CAST({column_sql(c)} AS VARCHAR), 'NULL')" for c in TABLES[table].cols) + ")"


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None, with_ids: bool = False):
    """Registers ``fn(tables) -> DataFrame`` under a key."""

    def register(fn: Callable[[DerivedTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(DerivedTables(spark, sf_dir, with_ids=with_ids))

        if name in CASES:
            raise ValueError(f"key used twice: {name}")
        CASES[name] = Case(run, with_relations(sql) if sql else None)
        return fn

    return register
