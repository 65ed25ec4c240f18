"""Query plans over the tables, each with SQL that says the same for another engine."""

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
