"""Result batches: a finite result pulled as Arrow record batches of a fixed size.

A thread of each reader runs jobs over a few partitions at a time, in order, one
group ahead of what is read; executors encode Arrow in the JVM. So the driver
holds two such groups and a batch, not the result. Batches are cut anew there:
all are full but the last. Jobs start when a reader is opened.
"""

from __future__ import annotations

import contextlib
import queue
import threading
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import InheritableThread
from pyspark.serializers import NoOpSerializer
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from ..errors import QueryError, StateError
from ..types import delivered, to_contract

#: Rows in a batch where nothing else is asked for.
BATCH_ROWS = 200_000
#: Partitions that are computed together.
AHEAD = 8


class Feed:
    """The Arrow batches of a DataFrame in order of its partitions; iterate once.

    Its jobs run in a thread and a job group of their own, so that neither the
    caller's thread nor other feeds notice a :meth:`stop`.
    """

    def __init__(self, df: DataFrame, ahead: int = AHEAD):
        self._df, self._ahead = delivered(df), ahead
        self._group = f"quarrow-{uuid.uuid4().hex}"
        self._ready: queue.Queue = queue.Queue(maxsize=1)
        self._taken, self._stopped = threading.Semaphore(1), threading.Event()
        self._thread = InheritableThread(target=self._run, name=self._group, daemon=True)
        self._thread.start()

    def _run(self) -> None:
        context = self._df.sparkSession.sparkContext
        try:
            context.setJobGroup(self._group, "batches", True)
            rows = self._df._jdf.toArrowBatchRdd().toJavaRDD()
            for first in range(0, total := rows.getNumPartitions(), self._ahead):
                chosen = context._jvm.java.util.ArrayList()
                for k in range(first, min(first + self._ahead, total)):
                    chosen.add(k)
                while not self._taken.acquire(timeout=0.5):
                    if self._stopped.is_set():
                        return
                if self._stopped.is_set():
                    return
                served = context._jvm.PythonRDD.runJob(context._jsc.sc(), rows, chosen)
                self._offer(list(_from_socket(served)))
            self._offer(None)
        except BaseException as failure:
            self._offer(failure)

    def _offer(self, item: object) -> None:
        while not self._stopped.is_set():
            try:
                return self._ready.put(item, timeout=0.5)
            except queue.Full:
                continue

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self._df.schema)
        while (group := self._ready.get()) is not None:
            if isinstance(group, BaseException):
                raise group
            self._taken.release()
            group.reverse()
            while group:
                yield pa.ipc.read_record_batch(pa.py_buffer(group.pop()), schema)

    def stop(self) -> None:
        """Cancel its jobs; from any thread. What waits for a batch gets an error."""
        if not self._stopped.is_set():
            self._stopped.set()
            self._cancel_jobs()
            if self._thread.is_alive():  # and may be about to start another job
                InheritableThread(target=self._cancel_until_ended, daemon=True).start()
        with contextlib.suppress(queue.Full):
            self._ready.put_nowait(RuntimeError("stopped"))


    def _cancel_jobs(self) -> None:
        self._df.sparkSession.sparkContext.cancelJobGroup(self._group)

    def _cancel_until_ended(self) -> None:
        with contextlib.suppress(Exception):  # the session may end meanwhile
            while self._thread.is_alive():
                self._cancel_jobs()
                time.sleep(0.2)


def _from_socket(served: object) -> Iterator[bytes]:
    from pyspark.core.rdd import _load_from_socket

    return _load_from_socket(served, NoOpSerializer())


def recut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of the contract's types with exactly ``rows`` rows, the last one excepted."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        columns = [to_contract(c, f.type) for c, f in zip(batch.columns, schema, strict=True)]
        batch = pa.RecordBatch.from_arrays(columns, schema=schema)
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, min(rows - count, batch.num_rows - at))
            held.append(part)
            count += part.num_rows
            at += part.num_rows
            if count == rows:
                yield _joined(held)
                held, count = [], 0
    if count:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


class BatchReader:
    """Forward-only reader of one result; its schema is known before the first batch.

    Iterate over it, or call :meth:`next` until it returns False and take
    :attr:`batch`. The first error ends it and stays in :attr:`error`. Use it as a
    context manager, or :meth:`close` it; :meth:`cancel` stops running jobs.
    """

    def __init__(self, df: DataFrame, schema: pa.Schema, sql: str = "", batch_rows: int = BATCH_ROWS, explain: Callable[[Exception], str] = str):
        self.schema, self.batch, self.error = schema, None, None
        self._sql, self._explain = sql, explain
        self._feed = Feed(df)
        self._batches = recut(iter(self._feed), schema, batch_rows)
        self._open, self._cancelled, self._references = True, False, 1
        self._lock = threading.Lock()

    def next(self) -> bool:
        """Fetch the next batch; the one before is let go."""
        self.batch = None
        if self.error is not None or not self._open:
            return False
        if self._cancelled:
            self.error = QueryError(self._sql, "select_execution", "context canceled")
            return False
        try:
            self.batch = next(self._batches, None)
        except Exception as failure:
            message = "context canceled" if self._cancelled else self._explain(failure)
            self.error = QueryError(self._sql, "select_execution", message)
            self.error.__cause__ = failure
        return self.batch is not None

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        while self.next():
            yield self.batch
        if self.error is not None:
            raise self.error

    def read_all(self) -> pa.Table:
        """What is left, as one table."""
        return pa.Table.from_batches(list(self), self.schema)

    def cancel(self) -> None:
        """Stop running jobs of this reader; can be called from any thread."""
        self._cancelled = True
        self._feed.stop()

    def retain(self) -> None:
        """One more holder, who will call :meth:`close` as well."""
        with self._lock:
            self._references += 1

    def close(self) -> None:
        """Give up one hold; the last one ends the reader. More calls do nothing."""
        with self._lock:
            if not self._open:
                return
            self._references -= 1
            if self._references:
                return
            self._open = False
        self._batches, self.batch = iter(()), None
        self._feed.stop()

    def __enter__(self) -> BatchReader:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


class Extractor:
    """Batches under the caller's own schema, step by step or at once."""

    def __init__(self, run: Callable[..., DataFrame], schema: pa.Schema):
        self._run, self.schema, self._rows = run, schema, BATCH_ROWS
        self._batches: Iterator[pa.RecordBatch] | None = None

    def set_batch_size(self, rows: int) -> None:
        if rows < 1:
            raise ValueError("a batch has at least one row")
        self._rows = rows

    def _checked(self, sql: str, args: tuple) -> DataFrame:
        df = self._run(sql, *args)
        if len(df.columns) != len(self.schema):
            raise StateError(f"column count mismatch: expected {len(self.schema)}, got {len(df.columns)}")
        return df

    def parse_all(self, sql: str, *args: object) -> pa.Table:
        """The whole result as one table; the partitions are fetched together."""
        table = delivered(self._checked(sql, args)).toArrow()
        columns = [to_contract(_single(c), f.type) for c, f in zip(table.columns, self.schema, strict=True)]
        return pa.Table.from_arrays(columns, schema=self.schema)

    def start(self, sql: str, *args: object) -> None:
        if self._batches is not None:
            raise StateError("parsing already in progress")
        self._batches = recut(iter(Feed(self._checked(sql, args))), self.schema, self._rows)

    def next_batch(self) -> tuple[pa.RecordBatch | None, bool]:
        """``(batch, done)``; a short batch is the last, a full one may be followed by none."""
        if self._batches is None:
            raise StateError("parsing not started")
        try:
            batch = next(self._batches, None)
        except Exception:
            self._batches = None
            raise
        done = batch is None or batch.num_rows < self._rows
        if done:
            self._batches = None
        return batch, done


def _single(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else (pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type))
