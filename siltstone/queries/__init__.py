"""Named queries on the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

from siltstone.queries.registry import ORACLES, QUERIES

MODULES = (
    "sources", "projections", "joins", "aggregates", "windows", "search", "reshape", "texts", "days",
    "checks", "expectations", "jobs",
)


def load() -> tuple[dict, dict]:
    for module in MODULES:
        importlib.import_module(f"siltstone.queries.{module}")
    return QUERIES, ORACLES
