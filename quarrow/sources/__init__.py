"""Where rows come from."""

from .tables import TABLES, catalog, read, register, scratch, table, write

__all__ = ["TABLES", "catalog", "read", "register", "scratch", "table", "write"]
