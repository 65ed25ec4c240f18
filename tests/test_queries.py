from __future__ import annotations

import datetime as dt
import math
import threading

import duckdb
import pyarrow.parquet as pq
import pytest

from quarrow import plans
from quarrow.sources import TABLES, register

from .conftest import DATA

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return bytes(value) if isinstance(value, bytearray) else value


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_matches_its_twin(spark, duck, name):
    df = plans.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in plans.oracle_sql():
        assert rows
        return
    twin = duck.sql(plans.oracle_sql()[name])
    assert sorted(twin.columns) == columns
    order = [twin.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[k]) for k in order) for r in twin.fetchall()), key=repr)


def test_joins_aggregates_and_nulls_of_small_tables(engine):
    nation = pq.read_table(f"{FOLDER}/nation.parquet").to_pylist()
    region = {r["r_regionkey"]: r["r_name"] for r in pq.read_table(f"{FOLDER}/region.parquet").to_pylist()}
    register(engine.spark, FOLDER, ("nation", "region"))
    sums: dict[str, int] = {}
    for n in nation:
        sums[region[n["n_regionkey"]]] = sums.get(region[n["n_regionkey"]], 0) + n["n_nationkey"]
    join = "SELECT r.r_name, SUM(n.n_nationkey) AS total FROM region r JOIN nation n ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name ORDER BY r.r_name"
    assert [tuple(r.values()) for r in engine.query(join).read_all().to_pylist()] == sorted(sums.items())
    held = [n["n_nationkey"] for n in nation]
    cte = "WITH m AS (SELECT AVG(n_nationkey) AS middle FROM nation) SELECT n.n_nationkey FROM nation n JOIN m ON n.n_nationkey > m.middle ORDER BY 1"
    assert engine.query(cte).read_all().column(0).to_pylist() == sorted(k for k in held if k > sum(held) / len(held))
    holed = "SELECT CASE WHEN r_regionkey > 2 THEN NULL ELSE r_regionkey END AS k FROM region ORDER BY k"
    some = sorted(k for k in region if k <= 2)
    gaps = [None] * (len(region) - len(some))
    assert engine.query(holed).read_all().column(0).to_pylist() == some + gaps
    assert engine.query(holed + " NULLS FIRST").read_all().column(0).to_pylist() == gaps + some


def test_range_join_passes_over_equal_values(spark, tmp_path):
    """One group with 200,000 equal values: compared one by one they are 40 billion pairs, none of them in range."""
    columns = "id AS p_partkey, 1 AS p_size, CASE WHEN id < 200000 THEN 900.0D ELSE 900.5D END AS p_retailprice"
    spark.range(200_003).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/part.parquet")
    late = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        found = plans.queries()["ext_range_join"](spark, str(tmp_path)).selectExpr("count(*)", "sum(a)", "sum(b)").first()
    finally:
        late.cancel()
    assert tuple(found) == (600_000, 3 * sum(range(200_000)), 200_000 * 600_003)


@pytest.mark.parametrize("width", [1, 0.1, 3.7])
def test_range_join_of_odd_values(spark, width):
    from quarrow.operators import range_join

    nan, inf = math.nan, math.inf
    odd = [None, nan, inf, -inf, 0.0, -0.0, 5e-324, -5e-324, -1e-17, 1e300, -1e300, 2.0**53, 2.0**53 - 1, 2.0**53 + 2, -(2.0**53), 1e19, 0.1, 0.2, 0.30000000000000004, 0.7, 0.9999999999999999, 1.0, 1.1, 3.7, 3.6999999999999997, 900.9, 901.0, 901.9, 901.9]
    rows = [(k, g, v) for k, (g, v) in enumerate((g, v) for g in (None, 1, 2) for v in odd)]
    rows += [(1000 + k, 7, 4.0) for k in range(1500)] + [(3000 + k, 7, 4.0 + k * width / 3) for k in range(5)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    found = range_join(df.withColumnsRenamed({"id": "a"}), df.selectExpr("id AS b", "g", "v", "nullif(id % 2, 0) AS odd"), "v", "g", width).collect()
    less = lambda x, y: not math.isnan(x) and (math.isnan(y) or x < y)
    held = [r for r in rows if r[1] is not None and r[2] is not None]
    wanted = [(a, b, b % 2 or None) for a, g, x in held for b, h, y in held if g == h and less(x, y) and less(y, x + width)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    with pytest.raises(ValueError):
        range_join(df, df, "v", "g", 0)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plans.queries()["filter_and_order"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "p_size" in plan.split("PushedFilters")[1].split("ReadSchema")[0] and "p_brand" not in plan.split("ReadSchema")[1]


def test_windowed_stream(spark):
    from quarrow.streaming.windows import stream, windowed

    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    finite = windowed(events, "ts", "value", "event_type").collect()
    source = stream(spark, f"{FOLDER}/events*.parquet", events.schema)
    query = windowed(source, "ts", "value", "event_type").writeStream.outputMode("complete").format("memory").queryName("window_totals").start()
    query.processAllAvailable()
    query.stop()
    found = spark.table("window_totals").collect()
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6))
    assert sorted(map(key, found)) == sorted(map(key, finite))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
