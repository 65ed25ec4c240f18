"""Tables of a folder of Parquet files as lazy frames and temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; columns and filters are pushed to its files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None) -> DataFrame:
    """A file or folder of a kind that Spark reads: parquet, orc, json, csv (with a header).

    Give the ``schema`` of text formats, else the data are read twice.
    """
    reader = spark.read.format(kind)
    reader = reader.option("header", True) if kind == "csv" else reader
    return (reader.schema(schema) if schema else reader).load(path)


def write(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """``df`` as files of that kind, one for each partition; what is at ``path`` is replaced."""
    writer = df.write.mode("overwrite").format(kind)
    (writer.option("header", True) if kind == "csv" else writer).save(path)


def scratch(spark: SparkSession) -> str:
    """A folder that all executors share: that of checkpoints, else the warehouse."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def register(spark: SparkSession, folder: str, names: tuple[str, ...] = TABLES) -> None:
    """Temporary views of tables, so that SQL finds them by name."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def catalog(spark: SparkSession) -> DataFrame:
    """``(table_name, is_temporary)`` of what the session can query."""
    found = spark.sql("SHOW TABLES")
    return found.selectExpr("tableName AS table_name", "isTemporary AS is_temporary")
