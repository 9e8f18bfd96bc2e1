"""Registered queries over the derived relations, grouped by area."""

from __future__ import annotations

import importlib

_AREAS = ("relations", "sources", "ingest", "quality", "security", "sector", "portfolio", "primitives")


def all_cases():
    from marketloom.suite.registry import CASES

    for area in _AREAS:
        importlib.import_module(f"marketloom.suite.{area}")
    return dict(CASES)
