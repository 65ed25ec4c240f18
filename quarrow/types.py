"""The typed result contract: source types, Spark types and Arrow types.

Results have eighteen source types. Everything else is rejected at the output
boundary. All result fields are nullable. Decimals leave as text with their
display scale; intervals are structs of months, days and nanoseconds inside
Spark and month-day-nano values in Arrow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERVAL = T.StructType([T.StructField("months", T.IntegerType()), T.StructField("days", T.IntegerType()), T.StructField("nanoseconds", T.LongType())])
INTERVAL_DDL = "STRUCT<months: INT, days: INT, nanoseconds: BIGINT>"


@dataclass(frozen=True)
class SourceType:
    """A type name of the source dialect, its canonical name, and its cast in Spark.

    ``cast`` has ``{x}`` for the operand and ``{n}`` for the first modifier.
    """

    name: str
    cast: str
    arrow: pa.DataType
    sized: str | None = None  # the cast where modifiers are given


_TEXT = "CAST({x} AS STRING)"
_CANONICAL = [
    SourceType("bool", "CAST({x} AS BOOLEAN)", pa.bool_()),
    SourceType("bytea", "CAST({x} AS BINARY)", pa.binary()),
    SourceType("char", f"left({_TEXT}, 1)", pa.string()),
    SourceType("name", f"left({_TEXT}, 63)", pa.string()),
    SourceType("int8", "CAST({x} AS BIGINT)", pa.int64()),
    SourceType("int2", "CAST({x} AS SMALLINT)", pa.int16()),
    SourceType("int4", "CAST({x} AS INT)", pa.int32()),
    SourceType("text", _TEXT, pa.string()),
    SourceType("float4", "CAST({x} AS FLOAT)", pa.float32()),
    SourceType("float8", "CAST({x} AS DOUBLE)", pa.float64()),
    SourceType("bpchar", _TEXT, pa.string(), f"rpad(left({_TEXT}, {{n}}), {{n}}, ' ')"),
    SourceType("varchar", _TEXT, pa.string(), f"left({_TEXT}, {{n}})"),
    SourceType("date", "CAST({x} AS DATE)", pa.date32()),
    SourceType("time", "CAST({x} AS TIME(6))", pa.time64("us")),
    SourceType("timestamp", "CAST({x} AS TIMESTAMP_NTZ)", pa.timestamp("us")),
    SourceType("timestamptz", "CAST({x} AS TIMESTAMP)", pa.timestamp("us", "UTC")),
    SourceType("interval", f"CAST({{x}} AS {INTERVAL_DDL})", pa.month_day_nano_interval()),
    SourceType("numeric", _TEXT, pa.string(), "CAST({x} AS DECIMAL({m}))"),
]
SOURCE_TYPES = {t.name: t for t in _CANONICAL}
#: Other spellings of the source types.
SPELLINGS = {
    "boolean": "bool", "smallint": "int2", "int": "int4", "integer": "int4", "bigint": "int8", "real": "float4", "double precision": "float8", "double": "float8", "float": "float8",
    "decimal": "numeric", "character varying": "varchar", "character": "bpchar", "string": "text", "binary": "bytea",
    "timestamp without time zone": "timestamp", "timestamp with time zone": "timestamptz", "time without time zone": "time", "timestamp_ntz": "timestamp",
}
#: Known names of types that a result cannot have.
UNSUPPORTED = frozenset({"oid", "uuid", "json", "jsonb", "xml", "inet", "cidr", "regclass", "point", "money", "bit", "tsvector"})


def canonical(name: str) -> str | None:
    """The canonical name of a source type, or None."""
    name = " ".join(name.lower().split())
    name = SPELLINGS.get(name, name)
    return name if name in SOURCE_TYPES else None


_SIMPLE = {
    T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(), T.ShortType: pa.int16(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.FloatType: pa.float32(), T.DoubleType: pa.float64(),
    T.StringType: pa.string(), T.VarcharType: pa.string(), T.CharType: pa.string(), T.DateType: pa.date32(), T.TimestampNTZType: pa.timestamp("us"), T.TimestampType: pa.timestamp("us", "UTC"),
    T.TimeType: pa.time64("us"), T.DecimalType: pa.string(),
}


def is_interval(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and kind.names == INTERVAL.names and [f.dataType for f in kind] == [f.dataType for f in INTERVAL]


def arrow_type(kind: T.DataType) -> pa.DataType | None:
    """The Arrow type of a result column of this Spark type; None where there is none."""
    if is_interval(kind):
        return pa.month_day_nano_interval()
    if isinstance(kind, T.ByteType):
        return pa.int16()
    return _SIMPLE.get(type(kind))


def arrow_schema(schema: T.StructType) -> tuple[pa.Schema | None, list[tuple[str, str]]]:
    """All-nullable Arrow schema, and the columns that stand against it."""
    kinds = [(f.name, f.dataType, arrow_type(f.dataType)) for f in schema]
    bad = [(name, kind.simpleString()) for name, kind, arrow in kinds if arrow is None]
    return (None if bad else pa.schema([pa.field(name, arrow, nullable=True) for name, _, arrow in kinds])), bad


def delivered(df: DataFrame) -> DataFrame:
    """``df`` as Spark sends it to Arrow: positional names, decimals as text."""
    names = [f"c{k}" for k in range(len(df.columns))]
    columns: list[Column] = []
    for name, field in zip(names, df.schema, strict=True):
        column = F.col(name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ByteType):
            column = column.cast("smallint")
        elif isinstance(field.dataType, T.TimeType):
            column = F.expr(f"time_diff('MICROSECOND', TIME'00:00:00', {name})")
        columns.append(column.alias(name))
    return df.toDF(*names).select(*columns)


def to_contract(array: pa.Array, kind: pa.DataType) -> pa.Array:
    """An array from Spark as the contract's type."""
    if kind == pa.month_day_nano_interval():
        return _intervals(array)
    if pa.types.is_timestamp(kind) and pa.types.is_timestamp(array.type):
        return array.cast(kind, safe=False)  # coarser units cut the rest off, towards zero
    return array if array.type == kind else array.cast(kind)


def _intervals(array: pa.StructArray) -> pa.Array:
    """Month-day-nano values, sixteen bytes each, from a struct's three children."""
    parts = array.flatten()
    missing = pc.or_(array.is_null(), parts[0].is_null())
    values = np.zeros(len(array), np.dtype([("months", "<i4"), ("days", "<i4"), ("nanoseconds", "<i8")]))
    for name, part in zip(values.dtype.names, parts, strict=True):
        values[name] = part.fill_null(0).to_numpy(zero_copy_only=False)
    valid = np.packbits(~missing.to_numpy(zero_copy_only=False), bitorder="little")
    return pa.Array.from_buffers(pa.month_day_nano_interval(), len(array), [pa.py_buffer(valid), pa.py_buffer(values)])
