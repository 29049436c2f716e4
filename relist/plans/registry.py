"""Registered queries: name → (spark callable, oracle SQL or None).

Each callable takes (spark, sf_dir) and returns a lazily planned DataFrame
over the whole input tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    from . import flow_queries, payload_queries, queries  # noqa: F401  (register on import)
