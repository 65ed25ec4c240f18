"""Helpers shared by the corpus operators: table access, cut lineage, Arrow blocks.

Conventions that every operator of this subpackage follows:

* only the columns an operator needs are selected, so extra columns, whatever
  their names, neither clash nor travel;
* a null text is treated as the empty text; a null id is carried as null;
* rows are never merged because their ids are equal: n input rows give n
  output rows, in any order;
* an empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker expands into Python objects at a time.
BLOCK_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut lineage: the one named in ``spark.checkpoint.dir``.

    Where that setting is missing, the warehouse, which executors share as well.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints").rstrip("/")


def written(df: DataFrame, name: str, release: bool = True) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Lineage ends there, so a lost executor costs at most the tasks that ran on
    it. The table is removed when the driver's JVM ends. ``release``: shuffle
    files of the plan and the executors' unused heap go now; not worth the time
    after small ones.
    """
    spark = df.sparkSession
    target = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    if release:
        released(spark)
    return spark.read.schema(df.schema).parquet(target)


def released(spark: SparkSession) -> None:
    """Let the context's cleaner delete shuffle files that no plan refers to any more.

    Executors collect their garbage, too: a JVM's heap grows to its limit long
    before it is needed, and only a full collection gives the rest back.
    """
    gc.collect()
    spark._jvm.System.gc()
    heaps_given_back(spark, spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1)


def heaps_given_back(spark: SparkSession, executors: int) -> None:
    """Run a full collection in so many tasks at once, which idle executors get one each; none without executors."""
    if executors > 0:
        calls = spark.range(0, executors, 1, executors).selectExpr("reflect('java.lang.System', 'gc')")
        calls.write.format("noop").mode("overwrite").save()


def dropped(df: DataFrame) -> None:
    """Remove a table made by :func:`written` that no later plan reads."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def blocks(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in each.

    A single value above the limit makes a block of its own.
    """
    for batch in batches:
        start = held = 0
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
    given_back()


def given_back() -> None:
    """Hand memory that is free back to the system: a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, with null texts as empty ones."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def quoted(name: str) -> str:
    """A column's name as an expression: dots and signs in it are its own."""
    return "`" + name.replace("`", "``") + "`"


def map_blocks(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: int = 1) -> DataFrame:
    """Run ``work`` on every block of ``df`` in Python workers."""

    def run(batches):
        for block in blocks(batches, column):
            yield work(block)

    return df.mapInArrow(run, schema)
