"""All registered queries and their DuckDB oracles."""
from __future__ import annotations

import importlib

MODULES = ["logs_queries", "detect_queries", "store_queries", "ml_queries"]


def _load():
    queries, oracles = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"{__package__}.{m}")
        queries.update(mod.QUERIES)
        oracles.update(mod.ORACLES)
    return queries, oracles


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
