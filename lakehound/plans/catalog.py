"""Registered queries: name -> (Spark callable, DuckDB SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables. Queries without SQL (model training, iterative or streaming
work) are checked on row counts by the driver and against brute force in tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from lakehound.plans import queries_fraud, queries_graph, queries_road, queries_routes  # noqa: F401
    from lakehound.plans import queries_ingest, queries_ml, queries_registry, queries_stream  # noqa: F401
