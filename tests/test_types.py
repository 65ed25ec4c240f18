from __future__ import annotations

import datetime as dt
import math

import pyarrow as pa
import pytest

from quarrow import QueryError

UTC = dt.timezone.utc

VALUES = [
    ("false::bool", pa.bool_(), False),
    ("'\\x00ff10'::bytea", pa.binary(), b"\x00\xff\x10"),
    ("''::bytea", pa.binary(), b""),
    ("E'\\\\x717561'::bytea", pa.binary(), b"qua"),
    ("(-32768)::int2", pa.int16(), -32768),
    ("2147483647::int4", pa.int32(), 2147483647),
    ("9223372036854775807::int8", pa.int64(), 9223372036854775807),
    ("'-Infinity'::float4", pa.float32(), -math.inf),
    ("'Infinity'::float8", pa.float64(), math.inf),
    ("'Grün, 緑, зелёный'::text", pa.string(), "Grün, 緑, зелёный"),
    ("''::text", pa.string(), ""),
    ("'granite'::varchar(4)", pa.string(), "gran"),
    ("'ox'::char(4)", pa.string(), "ox  "),
    ("'slate_7'::name", pa.string(), "slate_7"),
    ("'zinc'::\"char\"", pa.string(), "z"),
    ("'1968-02-29'::date", pa.date32(), dt.date(1968, 2, 29)),
    ("'07:08:09.25'::time", pa.time64("us"), dt.time(7, 8, 9, 250000)),
    ("'00:00:00.000001'::time", pa.time64("us"), dt.time(0, 0, 0, 1)),
    ("'1955-11-05 06:15:00.5'::timestamp", pa.timestamp("us"), dt.datetime(1955, 11, 5, 6, 15, 0, 500000)),
    ("'2031-03-04 01:30:00-05'::timestamptz", pa.timestamp("us", "UTC"), dt.datetime(2031, 3, 4, 6, 30, tzinfo=UTC)),
    ("'3 years 1 month 10 days 02:00:00.5'::interval", pa.month_day_nano_interval(), pa.MonthDayNano([37, 10, 7200500000000])),
    ("'-2 weeks'::interval", pa.month_day_nano_interval(), pa.MonthDayNano([0, -14, 0])),
    ("'6022.140'::numeric", pa.string(), "6022.140"),
    ("'0.0'::numeric", pa.string(), "0.0"),
    ("'-17.5'::numeric", pa.string(), "-17.5"),
    ("'NaN'::numeric", pa.string(), "NaN"),
    ("'-Infinity'::numeric", pa.string(), "-Infinity"),
    ("'0.000070'::numeric", pa.string(), "0.000070"),
    ("'31415926535897932384626433.83279502884197'::numeric", pa.string(), "31415926535897932384626433.83279502884197"),
    ("2.5::numeric(8,2)", pa.string(), "2.50"),
    ("('7' || repeat('3', 900))::numeric", pa.string(), "7" + "3" * 900),
]


@pytest.mark.parametrize("sql, kind, value", VALUES, ids=[v[0][:40] for v in VALUES])
def test_value(engine, sql, kind, value):
    with engine.query(f"SELECT {sql} AS v") as reader:
        assert reader.schema == pa.schema([pa.field("v", kind, nullable=True)])
        assert reader.read_all().column(0).to_pylist() == [value]


def test_nan_is_kept(engine):
    table = engine.query("SELECT 'NaN'::float8 AS v, 'NaN'::float4 AS w").read_all()
    assert all(math.isnan(c[0].as_py()) for c in table.columns)


def test_null_of_every_type(engine):
    kinds = ["bool", "bytea", '"char"', "name", "int8", "int2", "int4", "text", "float4", "float8", "bpchar(3)", "varchar(3)", "date", "time", "timestamp", "timestamptz", "interval", "numeric"]
    with engine.query("SELECT " + ", ".join(f"NULL::{k} AS c{i}" for i, k in enumerate(kinds))) as reader:
        table = reader.read_all()
    assert table.num_rows == 1 and all(c.null_count == 1 for c in table.columns)


def test_intervals_with_gaps(engine):
    sql = "SELECT CASE WHEN i % 3 = 0 THEN NULL::interval ELSE '2 days 00:00:01'::interval END AS v FROM generate_series(1, 10) i ORDER BY i"
    found = engine.query(sql).read_all().column(0).to_pylist()
    assert found == [None if i % 3 == 0 else pa.MonthDayNano([0, 2, 1_000_000_000]) for i in range(1, 11)]


def test_power(engine):
    sql = "SELECT 5 ^ 2 AS a, 2 ^ 3 ^ 2 AS b, 2 * 3 ^ 2 AS c, -3 ^ 2 AS d, (1 + 1) ^ -1 AS e, abs(-2) ^ '3'::int4 AS f, 10 - 3 ^ 2 AS g"
    assert list(engine.query(sql).read_all().to_pylist()[0].values()) == [25, 64, 18, 9, 0.5, 8, 1]
    for bad in ("SELECT ^ 2", "SELECT 2 ^"):
        with pytest.raises(QueryError):
            engine.query(bad)


def test_integers_divide_to_integers(engine):
    sql = """SELECT 7 / 2 AS a, -7 / 2 AS b, 7 / 2.0 AS c, 7 / 2::float8 AS d, i / 3 / 2 AS e, 100 / (i / 2) * 3 AS f, $2::text || '/' || ($1::int4 / 4)::text AS g, 'a/b' || (9 / 2)::text AS h,
             (SELECT max(k) / 2 FROM generate_series(1, 9) k) AS j, sum(i) / 2 AS s FROM generate_series(20, 20) i GROUP BY i / 3 / 2, i HAVING sum(i) / 7 = 2 ORDER BY i / 3"""
    table = engine.query(sql, 11, "it's / so").read_all()
    assert list(table.to_pylist()[0].values()) == [3, -3, "3.500000", 3.5, 3, 30, "it's / so/2", "a/b4", 4, 10]
    assert [str(table.schema.field(c).type) for c in "ae"] == ["int32", "int32"]


def test_names(engine):
    schema = engine.schema("SELECT 1, $1::int8, $2::int8, count(*), 1 AS one FROM (VALUES (1)) AS t(a)")
    assert schema.names == ["?column?", "int8", "int8", "count", "one"]


def test_column_functions(spark):
    from pyspark.sql import functions as F

    from quarrow import functions as C

    row = spark.range(1).select(
        C.bytea_text(F.lit("\\x4869")).alias("bytes"), C.numeric_text(F.lit("1.5"), 10, 3).alias("number"), C.bpchar(F.lit("abcdef"), 4).alias("cut"),
        C.epoch_days(F.lit("1999-12-31")).alias("days"), C.time_micros(F.lit("1969-12-31 23:59:59.5")).alias("time"),
    ).first()
    assert (bytes(row["bytes"]), row["number"], row["cut"], row["days"], row["time"]) == (b"Hi", "1.500", "abcd", 10956, 86_399_500_000)
