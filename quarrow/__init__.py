"""A typed query engine on Spark: parameterised SQL in, Arrow batches out."""

from .errors import EngineError, QueryError, SchemaError, SessionError, StateError
from .session import Engine
from .streaming.reader import BATCH_ROWS, BatchReader, Extractor

__all__ = ["BATCH_ROWS", "BatchReader", "Engine", "EngineError", "Extractor", "QueryError", "SchemaError", "SessionError", "StateError"]
