"""Relational operators as functions on DataFrames."""

from .relational import as_of_join, five_aggregates, null_statistics, ordered, range_join, series, top_k

__all__ = ["as_of_join", "five_aggregates", "null_statistics", "ordered", "range_join", "series", "top_k"]
