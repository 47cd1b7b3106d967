"""Registry of named queries (Spark callables) and their oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` built from library
operators over the driver tables; the oracle is DuckDB-runnable SQL over the
same tables with identical output column names.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_MODULES = [
    "jobflow.plans.balance_queries",
    "jobflow.plans.filter_queries",
    "jobflow.plans.aggregate_queries",
    "jobflow.plans.series_queries",
    "jobflow.plans.quality_queries",
    "jobflow.plans.clean_queries",
    "jobflow.plans.source_queries",
    "jobflow.plans.analytics_queries",
    "jobflow.plans.stream_queries",
]


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key``; ``sql`` is the oracle (None = rows-only check)."""
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)
