"""Registered queries over the given tables, and SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import query_events, query_ingest, query_tables, query_units, query_windows

_MODULES = (query_events, query_windows, query_tables, query_units, query_ingest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query: (spark, sf_dir) -> DataFrame."""
    return {name: run for module in _MODULES for name, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql}
