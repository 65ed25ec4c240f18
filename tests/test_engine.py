from __future__ import annotations

import threading
import time

import pyarrow as pa
import pytest

from quarrow import BATCH_ROWS, Engine, QueryError, SchemaError, SessionError, StateError

ERRORS = [
    ("INVALID SQL", (), "syntax error"),
    ("SELECT (1, 2", (), "syntax error"),
    ("SELECT * FROM no_such_table", (), "does not exist"),
    ("SELECT nope FROM (VALUES (1)) AS t(id)", (), "does not exist"),
    ("SELECT 'hello'::int4", (), "invalid input syntax for type integer"),
    ("SELECT * FROM (VALUES (1)) AS t(id) WHERE id = 'not a number'", (), "invalid input syntax for type"),
    ("SELECT $1::int4", (), "expected 1 arguments, got 0"),
    ("SELECT $1::int4", (1, 2), "expected 1 arguments, got 2"),
    ("SELECT 'no json'::json", (), "invalid input syntax"),
    ("SELECT 1::oid", (), "unsupported type oid"),
    ("SELECT ARRAY[1, 2]", (), "unsupported type"),
    ("SELECT gen_random_uuid()", (), "unsupported type uuid"),
    ("UPDATE t SET id = 1", (), "query returned no columns"),
    ("DROP TABLE t", (), "query returned no columns"),
    ("SELECT 1 / 0", (), "division by zero"),
]


@pytest.mark.parametrize("sql, args, message", ERRORS, ids=[e[0] for e in ERRORS])
def test_errors_when_opened(engine, sql, args, message):
    with pytest.raises(QueryError, match=message.replace("[", r"\[")) as caught:
        engine.query(sql, *args)
    assert caught.value.sql == sql and caught.value.operation in ("metadata_discovery", "select_execution")


def test_error_chain_and_cut_text(engine):
    with pytest.raises(QueryError) as caught:
        engine.query("SELECT ARRAY[1] AS a" + " " * 100)
    assert isinstance(caught.value.__cause__, SchemaError) and caught.value.__cause__.columns[0][0] == "a"
    assert str(caught.value).endswith("...)")


def test_parameters(engine):
    with engine.query("SELECT $1::int4 AS a, $2::text AS b, $3::bool AS c, $1::int8 + 1 AS d", 42, "it's $1", None) as reader:
        assert reader.read_all().to_pylist() == [{"a": 42, "b": "it's $1", "c": None, "d": 43}]


@pytest.mark.parametrize("rows, size, expected", [(25, 10, [10, 10, 5]), (20, 10, [10, 10]), (0, 10, []), (3, 10, [3])])
def test_batches_are_full_but_the_last(engine, rows, size, expected):
    with engine.query(f"SELECT n FROM generate_series(1, {rows}) n ORDER BY n", batch_rows=size) as reader:
        batches = list(reader)
    assert [b.num_rows for b in batches] == expected
    assert [v for b in batches for v in b.column(0).to_pylist()] == list(range(1, rows + 1))


def test_large_result_has_default_batches(engine):
    with engine.query("SELECT i::int8 AS id, random() AS v FROM generate_series(1, 500000) i") as reader:
        assert [b.num_rows for b in reader] == [BATCH_ROWS, BATCH_ROWS, 100_000]


def test_schema_without_execution(engine):
    schema = engine.schema("SELECT $1::int4 AS a, 'x'::bytea AS b")
    assert schema == pa.schema([("a", pa.int32()), ("b", pa.binary())])
    with engine.query("SELECT 1::int2 AS a WHERE false") as reader:
        assert reader.schema.field("a").type == pa.int16() and list(reader) == []


def test_errors_of_data_come_from_the_reader_and_stay(engine):
    reader = engine.query("SELECT 10 / (i - 500) AS v FROM generate_series(1, 1000) i")
    assert [reader.next() for _ in range(3)][-1] is False
    assert "division by zero" in str(reader.error) and reader.next() is False
    with pytest.raises(QueryError):
        list(reader)


def test_cancel(engine):
    reader = engine.query("SELECT count(*) AS n FROM generate_series(1, 2000000000) a JOIN generate_series(1, 1000) b ON a.a % 7 > b.b")
    threading.Timer(1.0, reader.cancel).start()
    start = time.monotonic()
    assert reader.next() is False and "context" in str(reader.error)
    assert time.monotonic() - start < 30
    cancelled = engine.query("SELECT 1 AS n")
    cancelled.cancel()
    assert cancelled.next() is False and "context" in str(cancelled.error)


def test_references(engine):
    reader = engine.query("SELECT 1 AS n")
    reader.retain()
    reader.close()
    assert reader.next()
    reader.close()
    reader.close()
    assert not reader.next() and reader.batch is None


def test_close(spark):
    adopted = Engine(spark)
    adopted.close()
    adopted.close()
    with pytest.raises(SessionError, match="closed"):
        adopted.query("SELECT 1")
    assert spark.range(1).count() == 1


def test_extractor(engine):
    schema = pa.schema([("n", pa.int64())])
    extractor = engine.extractor(schema)
    extractor.set_batch_size(10)
    with pytest.raises(StateError, match="parsing not started"):
        extractor.next_batch()
    extractor.start("SELECT i::int8 AS n FROM generate_series(1, 20) i")
    with pytest.raises(StateError, match="parsing already in progress"):
        extractor.start("SELECT 1")
    steps = [extractor.next_batch() for _ in range(3)]
    assert [(b.num_rows if b else None, done) for b, done in steps] == [(10, False), (10, False), (None, True)]
    with pytest.raises(StateError, match="column count mismatch"):
        extractor.parse_all("SELECT 1::int8 AS a, 2::int8 AS b")
    for rows in (3, 0):
        assert extractor.parse_all("SELECT i::int8 AS n FROM generate_series(1, $1::int4) i".replace("$1::int4", str(rows))).num_rows == rows


def test_extractor_units(engine):
    for unit, value in (("s", -446_751_900), ("ms", -446_751_900_123), ("us", -446_751_900_123_456), ("ns", -446_751_900_123_456_000)):
        sql = "SELECT '1955-11-05 06:14:59.876544'::timestamp AS t"
        kind = pa.timestamp(unit)
        assert engine.extractor(pa.schema([("t", kind)])).parse_all(sql).column(0).cast(pa.int64()).to_pylist() == [value]
        extractor = engine.extractor(pa.schema([("t", kind)]))
        extractor.start(sql)
        assert extractor.next_batch()[0].column(0).cast(pa.int64()).to_pylist() == [value]


LONG = "SELECT count(*) AS n FROM generate_series(1, 2000000000) a JOIN generate_series(1, 1000) b ON a.a % 7 > b.b"


def test_cancel_stops_its_own_reader_only(engine):
    first = engine.query("SELECT i FROM generate_series(1, 1000) i", batch_rows=10)
    slow = engine.query(LONG)
    assert first.next()
    threading.Timer(0.5, slow.cancel).start()
    start = time.monotonic()
    assert slow.next() is False and "context" in str(slow.error) and time.monotonic() - start < 20
    assert first.next() and sum(b.num_rows for b in first) == 980
    other = engine.query(LONG)
    third = engine.query("SELECT 1 AS n")
    assert third.next() and third.batch.num_rows == 1
    third.close()
    other.close()
    assert not other.next()
    assert engine.spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_jobs_start_when_a_reader_is_opened(engine):
    reader = engine.query("SELECT 10 / (i - 500) AS v FROM generate_series(1, 1000) i")
    deadline = time.monotonic() + 20
    while reader._feed._ready.empty() and time.monotonic() < deadline:
        time.sleep(0.05)
    assert not reader._feed._ready.empty() and reader.next() is False and "division by zero" in str(reader.error)


def test_a_given_session_keeps_its_settings(spark):
    names = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.timeType.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.sql("SELECT 5 AS held").createOrReplaceTempView("seen_by_the_engine")
    before = {k: spark.conf.get(k) for k in names}
    with Engine(spark, config={"spark.sql.session.timeZone": "Asia/Tokyo"}) as adopted:
        assert adopted.query("SELECT held FROM seen_by_the_engine").read_all().to_pylist() == [{"held": 5}]
        assert adopted.spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert {k: spark.conf.get(k) for k in names} == before
