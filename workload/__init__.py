"""CRM-shaped views of the given tables, the registered queries and their SQL counterparts."""

from workload import function_queries, load_queries, mart_queries, run_queries, source_queries  # noqa: F401 - they register their queries
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
