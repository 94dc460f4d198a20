"""Registered queries and their DuckDB oracle statements."""

from .duckdb_sql import oracle_sql
from .spark_queries import QUERIES, queries

__all__ = ["QUERIES", "oracle_sql", "queries"]
