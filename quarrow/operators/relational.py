"""Operators that results need beyond plain SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def series(spark: SparkSession, first: int, last: int, step: int = 1, name: str = "generate_series") -> DataFrame:
    """Integers from ``first`` to ``last`` inclusive; made where they are used, not shipped."""
    if not step:
        raise ValueError("step size cannot equal zero")
    return spark.range(first, last + (1 if step > 0 else -1), step).withColumnRenamed("id", name)


def five_aggregates(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, sum, average, least and greatest per key: one partial and one final hash aggregate."""
    v = F.col(value)
    return df.groupBy(key).agg(F.count("*").alias("row_count"), F.sum(v).alias("sum_value"), F.avg(v).alias("avg_value"), F.min(v).alias("min_value"), F.max(v).alias("max_value"))


def null_statistics(df: DataFrame, *columns: str) -> DataFrame:
    """Rows, and nulls of every column, in one pass."""
    return df.agg(F.count("*").alias("row_count"), *[(F.count("*") - F.count(c)).alias(f"{c}_nulls") for c in columns])


def ordered(column: str | Column, descending: bool = False, nulls: str | None = None) -> Column:
    """A sort key; without ``nulls`` ('first' or 'last') nulls are the largest values."""
    key = F.col(column) if isinstance(column, str) else column
    first = descending if nulls is None else nulls == "first"
    if descending:
        return key.desc_nulls_first() if first else key.desc_nulls_last()
    return key.asc_nulls_first() if first else key.asc_nulls_last()


def top_k(df: DataFrame, k: int, *keys: Column) -> DataFrame:
    """The first ``k`` rows under ``keys``: each task keeps k, the driver's merge k."""
    return df.orderBy(*keys).limit(k)


def as_of_join(left: DataFrame, right: DataFrame, on: str, by: str, value: str) -> DataFrame:
    """``left`` with ``value`` of the latest ``right`` row of its ``by`` group at or before its ``on``.

    Both sides go through one exchange on ``by`` and one sort; no pairs are made.
    Rows without an earlier one get null; of equal ``on`` the largest value counts.
    """
    names = left.columns
    rows = left.select(F.col(by).alias("g"), F.col(on).alias("t"), F.lit(1).alias("side"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.lit(None).cast(right.schema[value].dataType).alias("v"))
    marks = right.select(F.col(by).alias("g"), F.col(on).alias("t"), F.lit(0).alias("side"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.col(value).alias("v"))
    before = Window.partitionBy("g").orderBy("t", "side", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.unionByName(marks).withColumn("found", F.last("v", ignorenulls=True).over(before)).where("side = 1").select("row.*", F.col("found").alias(value))


#: Rows of one value that :func:`range_join` packs into one.
PACKED_ROWS = 1024


def range_join(left: DataFrame, right: DataFrame, on: str, by: str, width: float) -> DataFrame:
    """Pairs of a ``by`` group whose right ``on`` is above the left one by less than ``width``: the other columns of both.

    Each side goes through one exchange, by group and bucket of ``width``; left rows look
    in every bucket from theirs to that of ``on + width``, which hold all in range however
    the division rounds. There equal values are packed, packs are compared, and those in
    range unpacked, so that few comparisons are made which give no pairs, and no pair moves.
    """
    if not width > 0:
        raise ValueError("width of a range must be above zero")

    def bucket(value: Column) -> Column:
        return F.floor(value.cast("double") / width)

    def packed(df: DataFrame, value: str, rows: str, at: Column) -> DataFrame:
        named = [F.col(f"`{c}`").alias(f"{rows}{k}") for k, c in enumerate(df.columns) if c not in (by, on)]
        found = df.select(F.col(by).alias("g"), F.col(on).alias(value), F.struct(*named).alias(rows)).where(F.col("g").isNotNull() & F.col(value).isNotNull())
        found = found.withColumn("bucket", at).repartition("g", "bucket")
        place = F.row_number().over(Window.partitionBy("g", "bucket", value).orderBy(value))
        return found.withColumn("pack", F.floor(place / PACKED_ROWS)).groupBy("g", "bucket", value, "pack").agg(F.collect_list(rows).alias(rows)).drop("pack")

    low, top, high = F.col("low"), F.col("low") + width, F.col("high")
    lower, upper = packed(left, "low", "l", F.explode(F.sequence(bucket(low), bucket(top)))), packed(right, "high", "r", bucket(high))
    pairs = lower.join(upper.hint("merge"), ["g", "bucket"]).where((high > low) & (high < top))
    names = [F.col(f"{rows}{k}").alias(c) for rows, df in (("l", left), ("r", right)) for k, c in enumerate(df.columns) if c not in (by, on)]
    return pairs.select(F.inline("l"), "r").select("*", F.inline("r")).select(*names)
