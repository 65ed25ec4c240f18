"""Relational queries beyond the attested surface: what delegated SQL may also ask for.

These are extensions. Each is SQL that both engines read, or a DataFrame plan
with its own SQL.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import as_of_join, range_join
from ..session import Engine
from ..sources import read, register, scratch, table, write
from ..streaming.windows import sessions, windowed

ALL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def _add(name: str, tables: tuple[str, ...], sql: str, oracle: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, sf_dir, tables)
        return Engine(spark).frame(sql)

    ALL[f"ext_{name}"] = (run, oracle or sql)


_add("left_join", ("customer", "orders"), "SELECT c.c_custkey, count(o.o_orderkey) AS orders FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey")
_add("full_join", ("nation", "region"), "SELECT r.r_name, n.n_name FROM region r FULL JOIN (SELECT * FROM nation WHERE n_nationkey > 5) n ON r.r_regionkey = n.n_regionkey")
_add("semi_join", ("customer", "orders"), "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
_add("anti_join", ("customer", "orders"), "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
_add("distinct", ("lineitem",), "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
_add("count_distinct", ("lineitem",), "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag")
_add("having", ("orders",), "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey HAVING count(*) > 12")
_add("filter_aggregate", ("orders",), "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS final_orders FROM orders GROUP BY o_orderpriority")
_add("rollup", ("lineitem",), "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
_add("grouping_sets", ("lineitem",), "SELECT l_returnflag, l_linestatus, count(*) AS row_count FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
_add("window_rank", ("customer",), "SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS bigint) AS place FROM customer")
_add("window_frame", ("orders",), "SELECT o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_sum FROM orders")
_add("window_lag", ("events",), "SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events")
_add("union_all", ("customer", "supplier"), "SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey AS nationkey FROM supplier")
_add("intersect", ("customer", "supplier"), "SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey AS nationkey FROM supplier")
_add("except", ("nation", "supplier"), "SELECT n_nationkey AS nationkey FROM nation EXCEPT SELECT s_nationkey AS nationkey FROM supplier WHERE s_acctbal > 9000")
_add("offset", ("orders",), "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
_add("case_coalesce", ("events",), "SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'middle' ELSE 'low' END AS band, coalesce(event_type, 'none') AS kind FROM events")
_add("scalar_subquery", ("customer",), "SELECT c_custkey FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)")
_add("extract_year", ("orders",), "SELECT extract(YEAR FROM o_orderdate) AS order_year, count(*) AS orders FROM orders GROUP BY 1", "SELECT CAST(extract(YEAR FROM o_orderdate) AS INTEGER) AS order_year, count(*) AS orders FROM orders GROUP BY 1")
_add("date_trunc", ("orders",), "SELECT date_trunc('month', o_orderdate)::date AS month, count(*) AS orders FROM orders GROUP BY 1")
_add("right_join", ("orders", "customer"), "SELECT c.c_custkey, o.o_orderkey FROM orders o RIGHT JOIN customer c ON c.c_custkey = o.o_custkey AND o.o_totalprice > 150000")
_add("cross_join", ("region", "nation"), "SELECT r.r_name, n.n_name FROM region r CROSS JOIN nation n")
_add("intersect_all", ("customer", "supplier"), "SELECT c_nationkey AS nationkey FROM customer INTERSECT ALL SELECT s_nationkey AS nationkey FROM supplier")
_add("except_all", ("customer", "supplier"), "SELECT c_nationkey AS nationkey FROM customer EXCEPT ALL SELECT s_nationkey AS nationkey FROM supplier")
_add("cube", ("lineitem",), "SELECT l_returnflag, l_linestatus, count(*) AS row_count FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
_add("lateral", ("region", "nation"), "SELECT r.r_name, x.nations, x.last_name FROM region r, LATERAL (SELECT count(*) AS nations, max(n_name) AS last_name FROM nation WHERE n_regionkey = r.r_regionkey) AS x")
_add("recursive", (), "WITH RECURSIVE steps(n, total) AS (SELECT 1 AS n, 1 AS total UNION ALL SELECT n + 1, total + n + 1 FROM steps WHERE n < 40) SELECT n, total FROM steps")
_add("string_aggregate", ("nation",), "SELECT n_regionkey, string_agg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
_add("statistics", ("lineitem",), "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS spread, round(var_pop(l_discount), 9) AS variance, round(corr(l_quantity, l_extendedprice), 6) AS related, median(l_quantity) AS middle FROM lineitem GROUP BY l_returnflag")
_add("approximate", ("lineitem",), "SELECT l_returnflag, abs(approx_count_distinct(l_partkey) - count(DISTINCT l_partkey)) <= 0.2 * count(DISTINCT l_partkey) AS near FROM lineitem GROUP BY l_returnflag", "SELECT l_returnflag, true AS near FROM lineitem GROUP BY l_returnflag")
_add("mathematics", ("part",), "SELECT p_partkey, round(sqrt(p_retailprice), 6) AS root, round(ln(p_retailprice), 6) AS logarithm, mod(p_partkey, 7) AS rest, abs(p_size - 25) AS away, floor(p_retailprice)::int8 AS below, p_size ^ 2 AS square FROM part", "SELECT p_partkey, round(sqrt(p_retailprice), 6) AS root, round(ln(p_retailprice), 6) AS logarithm, p_partkey % 7 AS rest, abs(p_size - 25) AS away, CAST(floor(p_retailprice) AS BIGINT) AS below, pow(p_size, 2) AS square FROM part")
_add("regular_expressions", ("part",), "SELECT p_partkey, p_name ~ '^[a-m]' AS early, p_name !~* 'RING$' AS other, regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants FROM part".replace(", 'g'", ""), "SELECT p_partkey, regexp_matches(p_name, '^[a-m]') AS early, NOT regexp_matches(p_name, '(?i)RING$') AS other, regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants FROM part")
_add("text_functions", ("customer",), "SELECT c_custkey, upper(trim(c_name)) AS name, length(c_name) AS size, split_part(c_name, '#', 2) AS number, position('#' IN c_name) AS mark, replace(c_mktsegment, 'A', '*') AS segment, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS other FROM customer", "SELECT c_custkey, upper(trim(c_name)) AS name, CAST(length(c_name) AS INTEGER) AS size, split_part(c_name, '#', 2) AS number, CAST(position('#' IN c_name) AS INTEGER) AS mark, replace(c_mktsegment, 'A', '*') AS segment, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS other FROM customer")


def _frame(oracle: str) -> Callable:
    def keep(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        ALL[function.__name__] = (function, oracle)
        return function

    return keep


@_frame("SELECT e.event_id, e.user_id, p.event_id AS purchase FROM (SELECT * FROM events WHERE event_type <> 'purchase') e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.event_id >= p.event_id")
def ext_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", "event_id", F.col("event_id").alias("purchase"))
    return as_of_join(events.where("event_type <> 'purchase'").select("event_id", "user_id"), bought, "event_id", "user_id", "purchase")


@_frame("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_size = b.p_size AND b.p_retailprice > a.p_retailprice AND b.p_retailprice < a.p_retailprice + 1")
def ext_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    lower, upper = (parts.select("p_size", "p_retailprice", F.col("p_partkey").alias(name)) for name in "ab")
    return range_join(lower, upper, "p_retailprice", "p_size", 1)


@_frame("SELECT epoch_us(w) AS started, event_type, count(*) AS row_count FROM (SELECT event_type, unnest([time_bucket(INTERVAL 30 minutes, ts), time_bucket(INTERVAL 30 minutes, ts) - INTERVAL 30 minutes]) AS w FROM events) GROUP BY ALL")
def ext_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windowed(table(Engine(spark).spark, sf_dir, "events"), "ts", "value", "event_type", width="1 hour", slide="30 minutes")
    return found.select(F.unix_micros("window_start").alias("started"), "event_type", "row_count")


@_frame("SELECT epoch_us(min(ts)) AS started, user_id, count(*) AS row_count FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 hours THEN 0 ELSE 1 END AS opens FROM events)) GROUP BY user_id, session")
def ext_session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sessions(table(Engine(spark).spark, sf_dir, "events"), "ts", "value", "user_id", gap="6 hours")
    return found.select(F.unix_micros("window_start").alias("started"), "user_id", "row_count")


def _stored(kind: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
        path = f"{scratch(spark)}/nation-{kind}"
        write(rows, path, kind)
        return read(spark, path, kind, rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))

    ALL[f"ext_{kind}_files"] = (run, "SELECT n_nationkey, n_name, n_regionkey FROM nation")


for _kind in ("csv", "json", "orc"):
    _stored(_kind)


@_frame("SELECT c_custkey, reverse(c_mktsegment) AS turned FROM customer")
def ext_user_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vectorised function of the user's, called from SQL."""

    @F.arrow_udf("string")
    def turned(values: pa.Array) -> pa.Array:
        return pc.utf8_reverse(values)

    engine = Engine(spark)
    engine.spark.udf.register("turned", turned)
    register(engine.spark, sf_dir, ("customer",))
    return engine.frame("SELECT c_custkey, turned(c_mktsegment) AS turned FROM customer")
