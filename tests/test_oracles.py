"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from marketloom.suite import all_cases
from tests.conftest import SMALL, connect
from tools.check_oracle import compare

CASES = all_cases()

# At the smallest scale these parameters select nothing; the rows are compared at sf0.01.
MAY_BE_EMPTY = {"q09_eps_growth_strict", "q09_eps_growth_strict_universe"}


@pytest.fixture(scope="module")
def verdicts(spark, request):
    """Comparisons of the selected queries; their many small jobs run side by side."""
    con = connect(SMALL)

    def verdict(name):
        try:
            return compare(CASES[name].run(spark, SMALL), con.cursor(), CASES[name].sql)
        except Exception as error:  # reported by the test of that query
            return f"ERROR {error}"

    names = [i.callspec.params["name"] for i in request.session.items if "verdicts" in i.fixturenames]
    with ThreadPoolExecutor(6) as pool:
        return dict(zip(names, pool.map(verdict, names)))


def test_every_query_has_sql():
    assert [name for name, c in CASES.items() if c.sql is None] == []


@pytest.mark.parametrize("name", CASES)
def test_query_equals_sql(verdicts, name):
    if name in MAY_BE_EMPTY and verdicts[name].startswith("EMPTY"):
        return
    assert verdicts[name] == ""
