"""Operators of a training-data pipeline, and the queries and SQL that register them."""

from stratavox.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
