"""Mixing sources to target weights with hash-threshold histograms.

Each document has a 36-bit hash of its id. A first histogram sums words by
source and the hash's highest 12 bits; running sums within a source show the
bucket in which the budget ends. Only that bucket is refined by the next 12
bits, and once more. The result is one threshold per source; documents below it
are taken in the last, partial round. Nothing is sorted by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, quoted, written

# Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is at most so many times its size.
REPEATS = 3
#: Hexadecimal digits of the hash, and those that each histogram looks at.
HASH_DIGITS, LEVEL_DIGITS = 9, 3
#: Words, as everywhere in this subpackage: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A source as a join key in which null is a value of its own, last in order."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _place(identity: Column) -> Column:
    """A document's place on the line of hashes."""
    digest = F.md5(F.coalesce(identity.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``(key, source_size, target, rounds, budget)`` from ``(key, source_size)``.

    Water filling: with sources in order of size by weight, those before the
    first one that stays below its limit are at their limits. One row per source
    goes through the two windows.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy("key")) - 1)
    weighed = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS)).cast("int") + 1).cast("long"))
    limit = REPEATS * F.col("source_size")
    rising = Window.orderBy(limit / F.col("weight"), "key")
    level = (
        weighed.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum(limit).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("below", (F.col("total") - F.col("full")) * F.col("weight") < limit * F.col("open"))
        .withColumn("first", F.min(F.when(F.col("below"), F.struct((limit / F.col("weight")).alias("ratio"), "key", (F.col("total") - F.col("full")).alias("rest"), "open"))).over(everything))
    )
    rest, shares = F.col("first.rest"), F.col("first.open")
    share = F.col("weight") * rest
    capped = F.col("first").isNull() | (share >= limit * shares)
    target = F.when(capped, limit.cast("double")).otherwise(share.cast("double") / shares.cast("double"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return (
        level.select("key", "source_size", target.alias("target"))
        .withColumn("rounds", rounds)
        .withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size"))
    )


def _refined(narrow: DataFrame, state: DataFrame, level: int, last: bool) -> DataFrame:
    """``(key, base, budget)`` one level down: the bucket in which the budget ends.

    ``base`` is the hash at which the bucket starts. At the last level the
    bucket itself is taken if that comes nearer to the budget.
    """
    above = 4 * (HASH_DIGITS - LEVEL_DIGITS * level)
    width = above - 4 * LEVEL_DIGITS
    inside = narrow.join(state, "key").where(F.shiftright("place", above) == F.shiftright("base", above)) if level else narrow.join(state, "key")
    sums = inside.groupBy("key", F.shiftright("place", width).alias("bucket")).agg(F.sum("size").alias("held"), F.first("budget").alias("budget"))
    upto = F.sum("held").over(Window.partitionBy("key").orderBy("bucket"))
    ends = (
        sums.withColumn("upto", upto)
        .where(F.col("upto") > F.col("budget"))
        .groupBy("key")
        .agg(F.min(F.struct("bucket", "held", "upto", "budget")).alias("end"))
    )
    rest = F.col("end.budget") - (F.col("end.upto") - F.col("end.held"))
    bucket = F.col("end.bucket")
    if last:
        bucket = F.when(2 * rest > F.col("end.held"), bucket + 1).otherwise(bucket)
    found = ends.select("key", F.shiftleft(bucket, width).alias("base"), rest.alias("budget"))
    return state.select("key").join(found, "key", "left").select("key", F.coalesce("base", F.lit(0).cast("long")).alias("base"), F.coalesce("budget", F.lit(0.0)).alias("budget"))


def _narrow(df: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), _key(F.col(source_col)).alias("key"), words(F.col(text_col)).alias("size"), _place(F.col(id_col)).alias("place"))


def thresholds(narrow: DataFrame) -> DataFrame:
    """``(key, source_size, target, rounds, threshold)``: one written row per source."""
    plan = written(targets(narrow.groupBy("key").agg(F.sum("size").alias("source_size"))), "mix-targets", release=False)
    state = plan.select("key", F.lit(0).cast("long").alias("base"), "budget")
    levels, tables = HASH_DIGITS // LEVEL_DIGITS, []
    for level in range(levels):
        state = written(_refined(narrow, state, level, level == levels - 1), "mix-level", release=False)
        tables.append(state)
    result = written(plan.join(state.withColumnRenamed("base", "threshold"), "key").drop("budget"), "mix-plan", release=False)
    for table in [plan, *tables]:
        dropped(table)
    return result


def _copies() -> Column:
    return (F.col("rounds") + (F.col("place") < F.col("threshold")).cast("long")).alias("copies")


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(id_col, size, source_size, target, copies)`` of every row.

    Sources in order of code points, null last, weigh 5, 2, 1, repeating; targets
    share all words by weight and stop at three times their source's size.
    ``copies`` says how often the mix takes the document: whole rounds of the
    source, and once more below its threshold. Null text has no words and is
    taken like others. Rows with one id share their fate. An empty table gives
    an empty result. Reruns agree: the hash is of the id alone.
    """
    narrow = written(_narrow(df, id_col, source_col, text_col), "mix-sizes", release=False)
    return narrow.join(thresholds(narrow), "key").select(F.col("id").alias(id_col), "size", "source_size", "target", _copies())


def mixed_rows(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows that the mix takes, each as often as it does, with all their columns.

    As :func:`mix`: null sources are one source, null and empty texts have no words
    and are taken like others, equal ids share their fate, an empty table stays
    empty. Other columns' names do not matter.
    """
    narrow = written(_narrow(df, id_col, source_col, text_col), "mix-sizes", release=False)
    plan = thresholds(narrow)
    dropped(narrow)
    kept = [F.col(f"row.{quoted(c)}").alias(c) for c in df.columns]
    rows = df.select(_key(F.col(source_col)).alias("key"), _place(F.col(id_col)).alias("place"), F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"))
    taken = rows.join(plan, "key").select("row", _copies()).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*kept)


def words_taken(df: DataFrame) -> DataFrame:
    """The mix with the words it takes of each document, for reports."""
    return mix(df).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: The same mix by sorting, for an engine without this module.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9) AS BIGINT) AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
         CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS shares,
         row_number() OVER w AS n
  FROM r WINDOW w AS (ORDER BY 3 * source_size / weight, k)),
f AS (SELECT rest, shares FROM l WHERE rest * weight < 3 * source_size * shares ORDER BY n LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN f.rest IS NULL OR weight * f.rest >= 3 * source_size * f.shares THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * f.rest AS DOUBLE) / CAST(f.shares AS DOUBLE) END AS target
  FROM r LEFT JOIN f ON true),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM t),
h AS (
  SELECT source, place, CAST(sum(size) AS BIGINT) AS held FROM d GROUP BY source, place),
c AS (SELECT *, sum(held) OVER (PARTITION BY source ORDER BY place) AS upto FROM h),
e AS (
  SELECT c.source, min(place) AS place, arg_min(held, place) AS held, arg_min(b.target - b.rounds * b.source_size - (upto - held), place) AS rest
  FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source
  WHERE upto > b.target - b.rounds * b.source_size GROUP BY c.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(d.size * (b.rounds + CASE WHEN e.place IS NOT NULL AND (d.place < e.place OR (d.place = e.place AND 2 * e.rest > e.held)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""
