"""Errors that a caller of the engine sees."""

from __future__ import annotations

#: SQL text in messages is cut after so many characters.
SHOWN = 100


class EngineError(Exception):
    """Base of all errors of this package."""


class SessionError(EngineError):
    """No session can be had: it could not be made, or the engine is closed."""


class QueryError(EngineError):
    """A query failed while it was described or executed."""

    def __init__(self, sql: str, operation: str, message: str):
        shown = sql if len(sql) <= SHOWN else sql[:SHOWN] + "..."
        super().__init__(f"query failed during {operation}: {message} (SQL: {shown})")
        self.sql, self.operation, self.message = sql, operation, message


class SchemaError(EngineError):
    """Columns of types that results cannot have; ``columns`` lists names and types."""

    def __init__(self, columns: list[tuple[str, str]], message: str):
        super().__init__(f"no result schema for {len(columns)} columns: {message}")
        self.columns = columns


class StateError(EngineError):
    """A reader was used out of turn."""
