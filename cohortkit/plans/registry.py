"""Registry of the queries exposed through ``__spark_entry__``.

Each module under ``plans`` registers ``name -> (callable(spark, sf_dir), oracle SQL or None)``.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all():
    from . import extracts, tidy, analysis, regression  # noqa: F401  (registration side effect)
    return QUERIES, ORACLES
