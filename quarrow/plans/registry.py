"""Queries by name.

``source`` queries run through the engine's own dialect; ``frame`` queries are
written with the DataFrame API. ``ORACLE`` has the same query for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as C
from ..operators import five_aggregates, ordered, series, top_k
from ..operators import null_statistics as nulls_of
from ..session import Engine
from ..sources import TABLES, catalog, register, table
from . import extensions

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def frame(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its function's name is the query's."""

    def keep(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if oracle:
            _ORACLE[function.__name__] = oracle
        return function

    return keep


def source(name: str, sql: str, tables: tuple[str, ...] = (), args: tuple = (), oracle: str | None = None) -> None:
    """Register text of the source dialect; ``oracle`` where DuckDB words it otherwise."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, sf_dir, tables)
        return Engine(spark).frame(sql, *args)

    _QUERIES[name] = run
    _ORACLE[name] = oracle or sql


# Types ------------------------------------------------------------------------

source("types_integers", "SELECT l_linenumber::int2 AS small_value, l_linenumber::int4 AS int_value, l_orderkey::int8 AS big_value FROM lineitem", ("lineitem",))
source("types_floats", "SELECT l_quantity::float4 AS float_value, l_extendedprice::float8 AS double_value FROM lineitem", ("lineitem",))
source("types_boolean", "SELECT o_orderkey, (o_orderstatus = 'F')::bool AS is_final FROM orders", ("orders",))
source("types_text", "SELECT c_custkey, c_name::text AS text_value, c_name::varchar(10) AS varchar_value, c_name::name AS name_value FROM customer", ("customer",), oracle="SELECT c_custkey, c_name AS text_value, left(c_name, 10) AS varchar_value, left(c_name, 63) AS name_value FROM customer")
source("types_binary", "SELECT c_custkey, c_name::bytea AS bytes_value FROM customer", ("customer",), oracle="SELECT c_custkey, encode(c_name) AS bytes_value FROM customer")
source("types_date", "SELECT o_orderkey, o_orderdate::date AS date_value FROM orders", ("orders",))
source("types_timestamp", "SELECT event_id, ts::timestamp AS ts_value FROM events", ("events",))
source("types_timestamptz", "SELECT event_id, ts::timestamptz AS ts_value FROM events", ("events",), oracle="SELECT event_id, ts AT TIME ZONE 'UTC' AS ts_value FROM events")
source("numeric_as_string", "SELECT o_orderkey, o_totalprice::numeric(18,2)::text AS price_text FROM orders", ("orders",), oracle="SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text FROM orders")
source("bpchar_padding", "SELECT r_regionkey, r_name::char(25) AS padded FROM region", ("region",), oracle="SELECT r_regionkey, rpad(r_name, 25, ' ') AS padded FROM region")


@frame("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS day_number FROM orders")
def date_epoch_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", C.epoch_days(F.col("o_orderdate")).alias("day_number"))


@frame("SELECT event_id, epoch_us(ts) AS micros FROM events")
def timestamp_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", C.epoch_micros(F.col("ts")).alias("micros"))


@frame("SELECT event_id, epoch_us(ts) % 86400000000 AS micros FROM events")
def time_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", C.time_micros(F.col("ts")).alias("micros"))


@frame("SELECT event_id, CAST(ts AS TIME) AS time_value FROM events")
def types_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(Engine(spark).spark, sf_dir, "events").select("event_id", C.time_of_day(F.col("ts")).alias("time_value"))


@frame("SELECT l_orderkey, l_linenumber, CAST(l_linenumber * 12 + 2 AS INTEGER) AS months, CAST(l_quantity AS INTEGER) AS days, CAST(4 * 3600 + 5 * 60 AS BIGINT) * 1000000000 + CAST(round(l_discount * 1000000) AS BIGINT) * 1000 AS nanoseconds FROM lineitem")
def interval_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = C.interval_parts(F.col("l_linenumber"), F.lit(2), F.col("l_quantity"), F.lit(4), F.lit(5), F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", parts.alias("i")).select("l_orderkey", "l_linenumber", "i.*")


source("float_specials", "SELECT 'Infinity'::float8 AS plus_inf, '-Infinity'::float8 AS minus_inf, 'NaN'::float8 AS not_number")
source("bytea_literal", "SELECT '\\xDEADBEEF'::bytea AS bytes_value", oracle="SELECT '\\xDE\\xAD\\xBE\\xEF'::BLOB AS bytes_value")
source("literal_values", "SELECT 1 AS num, 'hello' AS txt, true AS flag")
source("mixed_types", "SELECT 42::int4 AS int_value, 'text'::text AS text_value, true::bool AS bool_value, '2024-08-15'::date AS date_value, 7::int2 AS small_value")
source("all_nulls", "SELECT NULL::bool AS a, NULL::int4 AS b, NULL::text AS c, NULL::date AS d, NULL::bytea AS e")
source("values_with_nulls", "SELECT id, name, score, active FROM (VALUES (10, 'granite', 2.7::float8, NULL), (20, 'pumice', NULL, true), (30, NULL, 2.6::float8, false), (40, 'slate', 2.8::float8, true), (NULL, NULL, NULL, NULL)) AS stones(id, name, score, active)")


# Expressions --------------------------------------------------------------------

source("concat_cast", "SELECT 'user_' || c_custkey::text AS user_name FROM customer", ("customer",))
source("string_repeat", "SELECT r_regionkey, repeat(r_name, 3) AS repeated FROM region", ("region",))
source("series_five_columns", "SELECT i::int8 AS id, i * 3.14::float8 AS score, i % 2 = 0 AS active, 'user_' || i::text AS name, '2023-01-01'::date + i AS created_date FROM generate_series(1, 10000) AS i", oracle="SELECT i AS id, i * CAST(3.14 AS DOUBLE) AS score, i % 2 = 0 AS active, 'user_' || CAST(i AS VARCHAR) AS name, DATE '2023-01-01' + CAST(i AS INTEGER) AS created_date FROM range(1, 10001) AS t(i)")
source("series_select_list", "SELECT generate_series(1, 25) AS n", oracle="SELECT CAST(unnest(range(1, 26)) AS INTEGER) AS n")


# Filters --------------------------------------------------------------------------

source("table_scan", "SELECT * FROM supplier", ("supplier",))
source("filter_and_order", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size = 11 AND p_retailprice < 1000 ORDER BY p_retailprice, p_partkey", ("part",))
source("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_size > 27 AND p_retailprice >= 900 AND p_name LIKE '%ring'", ("part",))
source("parameterized_filter", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice < $1 AND p_size >= $2", ("part",), (950.0, 10), oracle="SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice < 950.0 AND p_size >= 10")
source("empty_result", "SELECT n_nationkey, n_name FROM nation WHERE false", ("nation",))
source("exists_scalar", "SELECT r_regionkey, EXISTS (SELECT 1 FROM nation WHERE n_regionkey = r_regionkey) AS has_nations FROM region", ("region", "nation"))
source("exists_uncorrelated", "SELECT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = 3) AS found, EXISTS (SELECT 1 FROM nation WHERE n_nationkey = 1000) AS missing", ("nation",))


# Joins and aggregates -----------------------------------------------------------

source("join_group_sum", "SELECT c.c_name, SUM(o.o_totalprice) AS total FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_name ORDER BY c.c_name", ("customer", "orders"))
source("cte_above_average", "WITH nation_avg AS (SELECT c_nationkey, AVG(c_acctbal) AS avg_balance FROM customer GROUP BY c_nationkey) SELECT c.c_name, c.c_acctbal, n.avg_balance FROM customer c JOIN nation_avg n ON c.c_nationkey = n.c_nationkey WHERE c.c_acctbal > n.avg_balance ORDER BY c.c_name", ("customer",))
source("global_count", "SELECT COUNT(*) AS row_count FROM lineitem", ("lineitem",))
source("derived_table", "SELECT s.n_regionkey, s.nations FROM (SELECT n_regionkey, COUNT(*) AS nations FROM nation GROUP BY n_regionkey) AS s WHERE s.nations > 1", ("nation",))


@frame("SELECT c_mktsegment, count(*) AS row_count, sum(c_acctbal) AS sum_value, avg(c_acctbal) AS avg_value, min(c_acctbal) AS min_value, max(c_acctbal) AS max_value FROM customer GROUP BY c_mktsegment")
def aggregate_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return five_aggregates(table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal")


# Order and limit ------------------------------------------------------------------


@frame("SELECT CASE WHEN r_regionkey % 2 = 1 THEN NULL ELSE r_regionkey END AS id, r_name FROM region ORDER BY id NULLS FIRST, r_name")
def order_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("r_regionkey") % 2 != 1, F.col("r_regionkey"))
    return table(spark, sf_dir, "region").select(odd.alias("id"), "r_name").orderBy(ordered("id", nulls="first"), "r_name")


@frame("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 100, F.col("o_orderkey"))


source("order_default_nulls", "SELECT x.id, x.r_name FROM (SELECT CASE WHEN r_regionkey < 2 THEN NULL ELSE r_regionkey END AS id, r_name FROM region) AS x ORDER BY x.id DESC, x.r_name LIMIT 3", ("region",), oracle="SELECT id, r_name FROM (SELECT CASE WHEN r_regionkey < 2 THEN NULL ELSE r_regionkey END AS id, r_name FROM region) AS x ORDER BY id DESC NULLS FIRST, r_name LIMIT 3")


# Results ----------------------------------------------------------------------------


@frame("SELECT count(*) AS row_count, count(*) - count(user_id) AS user_id_nulls, count(*) - count(value) AS value_nulls FROM (SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events)")
def null_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    holed = events.select(F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))
    return nulls_of(holed, "user_id", "value")


@frame("SELECT batch, count(*) AS row_count FROM (SELECT (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) - 1) // 20000 AS batch FROM lineitem) GROUP BY batch")
def batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the batches that a reader gives; it drains the whole table."""
    register(spark, sf_dir, ("lineitem",))
    with Engine(spark).query("SELECT l_orderkey, l_linenumber FROM lineitem", batch_rows=20_000) as reader:
        counts = [(k, batch.num_rows) for k, batch in enumerate(reader)]
    return spark.createDataFrame(counts, "batch long, row_count long")


@frame(f"SELECT unnest([{', '.join(repr(t) for t in TABLES)}]) AS table_name, true AS is_temporary")
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the engine's catalog lists, of the tables that this query registers."""
    register(spark, sf_dir)
    return catalog(Engine(spark).spark).where(F.col("table_name").isin(*TABLES))


@frame("SELECT 1000 AS row_count, 0 AS outside, true AS varied, true AS repeatable")
def random_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be told of random numbers: how many, in [0, 1), not all alike, equal for equal seeds."""
    drawn = series(spark, 1, 1000, name="id").select(F.rand(42).alias("value"), F.rand(42).alias("again"))
    outside = F.count(F.when((F.col("value") < 0) | (F.col("value") >= 1), True))
    return drawn.agg(F.count("*").cast("int").alias("row_count"), outside.cast("int").alias("outside"), (F.count_distinct("value") > 900).alias("varied"), F.min(F.col("value") == F.col("again")).alias("repeatable"))


for _name, (_run, _sql) in extensions.ALL.items():
    _QUERIES[_name], _ORACLE[_name] = _run, _sql


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
