"""Registry of runnable queries: name -> (Spark plan, oracle SQL or None).

Each Spark plan takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the full input tables. The SQL string is an independent DuckDB rendering of
the same operator on the same tables (``None`` = rows-only check)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql() if callable(sql) else sql
        return fn
    return deco


def load_all() -> None:
    from quarry.plans import (text_queries, graph_queries, series_queries,  # noqa: F401
                              tabular_queries, path_queries, model_queries,
                              tree_queries, source_queries, file_queries)
