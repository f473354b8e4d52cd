"""Registry of queries: a Spark function each, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.oracle_views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str, *views: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query with its SQL; ``views`` are the CRM views that the SQL reads."""
    def register(f: Query) -> Query:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = f
        ORACLE[key] = with_views(sql, *views)
        return f

    return register
