"""Hand-sized relations for the unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from marketloom.schema import TABLES


def d(text):
    return dt.date.fromisoformat(text)


def table(spark, name, rows):
    """Typed rows of a table; short tuples are filled up with NULL."""
    struct = TABLES[name].struct
    filled = []
    for row in rows:
        row = list(row) + [None] * (len(struct) - len(row))
        cells = []
        for value, field in zip(row, struct):
            kind = field.dataType.typeName()
            if value is not None and kind == "decimal":
                value = Decimal(str(value))
            elif value is not None and kind == "date" and isinstance(value, str):
                value = d(value)
            cells.append(value)
        filled.append(tuple(cells))
    return spark.createDataFrame(filled, struct)


def prices(spark, *rows):
    """(security_id, date, close[, volume]) as Price."""
    return table(spark, "Price", [(r[0], r[1], r[2], r[2], r[2], r[2], r[3] if len(r) > 3 else 10) for r in rows])


def market(spark, **overrides):
    """A small market: two sectors, three companies, a benchmark fund and an option."""
    base = {
        "Sector": [(1, "Technology"), (2, "Energy")],
        "Industry": [(1, "Software", 1), (2, "Chips", 1), (3, "Oil", 2)],
        "Company": [(1, "Alpha", 1, "US"), (2, "Beta", 2, "US"), (3, "Gamma", 3, "US")],
        "Exchange": [(1, "One", "US", "America/New_York"), (2, "Two", "US", "America/New_York")],
        "Security": [(1, "AAA", 1, "USD", "stock"), (2, "BBB", 1, "USD", "stock"), (3, "CCC", 1, "USD", "stock"),
                     (4, "SPY", 2, "USD", "etf"), (5, "AAA250418C00200000", 2, "USD", "option")],
        "Stock": [(1, 1), (2, 2), (3, 3)],
        "ETF": [(4, "Basket", 0.1)],
        "Option_Contract": [(1, 5, "2025-04-18", 200, "call", 0.3, 10)],
        "Portfolio": [(1, "Sample", "Alice"), (2, "Mine", "u:me"), (3, "Theirs", "u:you")],
        "Holding": [(1, 1, 10, 5), (2, 4, 2, 100)],
        "Price": [],
        "Financial_Snapshot": [],
        "Corporate_Action": [],
    }
    tables = {}
    for name, rows in base.items():
        given = overrides.get(name, rows)
        tables[name] = table(spark, name, given) if isinstance(given, list) else given
    return tables


def rows(df):
    return [tuple(r) for r in df.collect()]
