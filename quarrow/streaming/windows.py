"""Windowed aggregation of unbounded input: an extension for tables that keep growing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder as they appear."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(folder)


def windowed(events: DataFrame, time: str, value: str, *keys: str, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Count and sum per window and keys; rows later than ``late`` are left out.

    Windows tumble, or with ``slide`` a new one starts after each such time. State
    is dropped once a window is past the watermark, so it does not grow with the
    stream. Works on finite frames as well.
    """
    return _totals(events, time, value, keys, late, F.window("at", width, slide) if slide else F.window("at", width))


def sessions(events: DataFrame, time: str, value: str, *keys: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """As :func:`windowed`, by runs of rows of the same keys with less than ``gap`` between neighbours."""
    return _totals(events, time, value, keys, late, F.session_window("at", gap))


def _totals(events: DataFrame, time: str, value: str, keys: tuple[str, ...], late: str, window: Column) -> DataFrame:
    timed = events.withColumn("at", F.col(time).cast("timestamp")).withWatermark("at", late)
    totals = timed.groupBy(window.alias("window"), *keys).agg(F.count("*").alias("row_count"), F.sum(value).alias("sum_value"))
    return totals.select(F.col("window.start").alias("window_start"), *keys, "row_count", "sum_value")
