"""Which sets hold few enough shingles of their own to be similar to another set.

A shingle that only one set holds cannot be shared, and most shingles are such.
This finds the sets that have enough others, over the whole corpus, with one
exchange of packed arrays:

* a *shard* is some thousands of sets of one task. Its distinct shingles are cut
  into buckets by their upper bits; a row carries one bucket's shingles (their
  lower 40 bits) with the set of the shard that each is from. What two sets of
  the shard share is sent once, as shared, and not again by the same task while
  a table of fixed size remembers it: a shingle of all documents comes to a row
  or so for each task;
* a bucket's group finds the shingles that came once, and answers each shard
  with how many of those each of its sets has.

Buckets grow in number with the corpus, not in size. Where lower bits agree by
chance, a shingle passes for shared; sets are compared exactly later on.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mixed

#: Shingles and sets of a shard, about and at most; bytes of text for each bucket.
SHARD, SHARD_SETS, BUCKET_BYTES = 1 << 19, 60_000, 8 << 20
#: Bits that a row keeps of a shingle, and of those above them that tell the bucket.
LOW, HIGH = 40, 24
#: Places of the table of shingles that a task has sent as shared.
SENT = 1 << 18
#: The set of a shingle that needs no answer.
NONE = (1 << 16) - 1


def _packed(values: np.ndarray, starts: np.ndarray, width: int) -> pa.Array:
    """Binary values: the first ``width`` bytes of each number, cut at ``starts``."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)[:, :width]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((starts * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


def _unpacked(held: pa.Array) -> np.ndarray:
    """The shingles' lower bits from rows of five bytes for each."""
    raw = np.frombuffer(b"".join(held.to_pylist()), np.uint8).reshape(-1, LOW // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, : LOW // 8] = raw
    return wide.view(np.uint64).ravel()


def _random_id() -> int:
    """A shard's name; another one when a task runs again, so that answers to a lost attempt are never taken for its own."""
    return int.from_bytes(os.urandom(8), "little") >> 1


class _Shards:
    """Gathers a task's sets and gives rows ``(bucket, shard, shingles, owners)``; a row without owners has the sets' sizes and hashes."""

    def __init__(self, buckets: int):
        self.buckets, self.sent = buckets, np.zeros(SENT, np.uint64)
        self.h: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []

    def add(self, h: np.ndarray, first: np.ndarray, keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = np.diff(first)
        if self.h and (sum(map(len, self.h)) + len(h) > SHARD or sum(map(len, self.sizes)) + len(sizes) > SHARD_SETS):
            yield from self.rows()
        self.h.append(h)
        self.sizes.append(sizes)
        self.keys.append(np.stack(keys))

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.h:
            return
        h, sizes, keys = np.concatenate(self.h), np.concatenate(self.sizes), np.concatenate(self.keys, axis=1)
        self.h, self.sizes, self.keys = [], [], []
        _, one = np.unique(keys, axis=1, return_index=True)  # of equal sets, one asks
        stays = np.zeros(len(sizes), bool)
        stays[one] = True
        stays &= sizes > 0
        h = h[np.repeat(stays, sizes)]
        sizes, keys = sizes[stays], keys[:, stays]
        for low in range(0, len(sizes), NONE):  # one round, but for a block of very many tiny texts
            part = slice(low, low + NONE)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield self._shard(h[ends[low] : ends[min(low + NONE, len(sizes))]], sizes[part], keys[:, part])

    def _shard(self, h: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(h, kind="stable")
        owner = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)[order]
        h = h[order]
        heads = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        count = np.diff(np.append(heads, len(h)))
        h, owner = h[heads], owner[heads]
        owner[count > 1] = NONE
        place = (mixed(h) % np.uint64(SENT)).astype(np.int64)
        fresh = self.sent[place] != h
        shared = fresh & (owner == NONE)
        self.sent[place[shared]] = h[shared]
        h, owner = h[fresh], owner[fresh]
        bucket = ((h >> np.uint64(LOW)) * np.uint64(self.buckets) >> np.uint64(HIGH)).astype(np.int64)
        order = np.lexsort((owner, bucket))
        h, owner, bucket = h[order], owner[order], bucket[order]
        heads = np.flatnonzero(np.append(len(bucket) > 0, bucket[1:] != bucket[:-1]))
        starts = np.append(heads, len(h))
        shard = _random_id()
        about = np.concatenate([keys, sizes[None].astype(np.int64)]).tobytes()
        return pa.record_batch(
            [
                pa.array(np.append(bucket[heads], shard % self.buckets).astype(np.int32)),
                pa.array(np.full(len(heads) + 1, shard)),
                pa.concat_arrays([_packed(h, starts, LOW // 8), pa.array([about], pa.binary())]),
                pa.concat_arrays([_packed(owner, starts, 2), pa.array([None], pa.binary())]),
            ],
            names=["bucket", "shard", "shingles", "owners"],
        )


def _answers(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket: how many shingles of each set came from no other; sizes and hashes pass."""
    shingles, owners, shards = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
    for batch in batches:
        about = batch.filter(batch.column(3).is_null())
        if about.num_rows:
            yield pa.record_batch([about.column(1), about.column(2), pa.nulls(about.num_rows, pa.binary())], names=["shard", "held", "counts"])
        batch = batch.filter(batch.column(3).is_valid())
        if batch.num_rows:
            shingles.append(_unpacked(batch.column(2)))
            owners.append(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint16))
            shards.append(np.repeat(batch.column(1).to_numpy(), [len(x) // 2 for x in batch.column(3).to_pylist()]))
    shingle, owner, shard = np.concatenate(shingles), np.concatenate(owners), np.concatenate(shards)
    order = np.argsort(shingle)
    shingle = shingle[order]
    alone = np.ones(len(order), bool)
    alone[1:] &= shingle[1:] != shingle[:-1]
    alone[:-1] &= shingle[1:] != shingle[:-1]
    at = order[alone]
    at = at[owner[at] != NONE]
    names, name = np.unique(shard[at], return_inverse=True)
    sets, counts = np.unique(name.astype(np.int64) << 16 | owner[at], return_counts=True)
    starts = np.searchsorted(sets >> 16, np.arange(len(names) + 1))
    yield pa.record_batch([pa.array(names), _packed((sets & NONE).astype(np.uint16), starts, 2), _packed(counts.astype(np.uint32), starts, 4)], names=["shard", "held", "counts"])


def sets_that_share(data: DataFrame, sets: Callable, least: Callable, n_bytes: int) -> DataFrame:
    """``(f1, f2)``, perhaps repeated, of the sets with at least ``least(size)`` shared shingles.

    ``sets`` gives a task's ``(h, first, [f1, f2])`` from its batches; ``least``
    works on arrays of sizes. Equal sets in different tasks share everything, so
    both are found. ``n_bytes``: of all text.
    """
    buckets = max(1, min(1 << HIGH, -(-n_bytes // BUCKET_BYTES)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(buckets)
        for h, first, keys in sets(batches):
            yield from shards.add(h, first, keys)
        yield from shards.rows()

    def judge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone, about = np.zeros(1 << 16, np.int64), None
        for batch in batches:
            for held, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if counts is None:
                    about = np.frombuffer(held, np.int64).reshape(3, -1)
                else:
                    alone[np.frombuffer(held, np.uint16)] += np.frombuffer(counts, np.uint32)
        if about is not None:
            enough = about[2] - alone[: about.shape[1]] >= least(about[2])
            yield pa.record_batch([pa.array(about[0][enough]), pa.array(about[1][enough])], names=["f1", "f2"])

    sent = data.mapInArrow(send, "bucket int, shard long, shingles binary, owners binary")
    answered = sent.groupBy("bucket").applyInArrow(_answers, "shard long, held binary, counts binary")
    return answered.groupBy("shard").applyInArrow(judge, "f1 long, f2 long")


def marks(hashes: DataFrame, width: int) -> np.ndarray:
    """Bits at the places ``f1`` modulo ``width`` of all rows; of fixed size, whatever their number."""
    place = F.expr(f"pmod(f1, {width}) + 1")
    rows = hashes.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(width // 8, np.uint8)
    for row in rows.collect():  # width / 32768 rows of 4 kB
        bits[(row["part"] - 1) * 4096 :][:4096] = np.frombuffer(row["bits"], np.uint8)
    return bits
