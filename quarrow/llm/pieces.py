"""Work done once for each distinct pre-token of a corpus, and joined back to its documents.

Documents are cut into pre-tokens in *shards* of a task. A shard numbers its
distinct pre-tokens. Two exchanges follow:

* by bucket (a hash of the pre-token): a group sees the pre-tokens of all shards
  that fall into its bucket, works on each distinct one once, and answers every
  shard with what came out;
* by shard: answers meet the shard's documents, which are cut a second time and
  come as runs of numbers. So texts are read twice, and documents shuffled once.

A pre-token of all documents is one entry for each shard, however often it
occurs. Buckets grow in number with the corpus, not in size; a shard is bounded
by its text and by its distinct pre-tokens. All that is shuffled is packed.

Shards are named by partition and order, so the rows of a partition have to come
in the same order when they are read again, as they do from files. Where they do
not, digests of the numbering tell, and the job fails.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import blocks, given_back

#: Bytes of text and distinct pre-tokens that end a shard; bytes of text for each bucket.
SHARD_BYTES, SHARD_PIECES, BUCKET_BYTES = 16 << 20, 200_000, 8 << 20
#: Characters of a text that are cut at a time, about.
CHARACTERS = 1 << 19
#: Distinct pre-tokens that are worked on at a time, and bytes of them, about.
AT_ONCE, AT_ONCE_BYTES = 50_000, 1 << 20


def parts_of(text: str, cut: Callable[[str, int], int]) -> Iterator[str]:
    """A text, or long ones in parts; ``cut`` gives a place at or after an offset where no pre-token spans."""
    at = 0
    while len(text) - at > CHARACTERS:
        end = cut(text, at + CHARACTERS)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def zipped(values: np.ndarray) -> bytes:
    """Numbers below 2^32, packed: all first bytes, then all second ones, and so on."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return squeezed(planes[: 4 if planes[3].any() else 3 if planes[2].any() else 2].tobytes(), len(values))


def unzipped(held: bytes) -> np.ndarray:
    size = int.from_bytes(held[:8], "little")
    planes = np.frombuffer(stretched(held), np.uint8).reshape(-1, size) if size else np.zeros((0, 0), np.uint8)
    out = np.zeros((size, 4), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<u4").ravel()


def squeezed(data: bytes, about: int = 0) -> bytes:
    """Bytes, packed, behind a number and their size."""
    return about.to_bytes(8, "little") + len(data).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(data, asbytes=True)


def stretched(held: bytes) -> bytes:
    return pa.decompress(held[16:], int.from_bytes(held[8:16], "little"), "zstd", asbytes=True)


class Answers:
    """What the work gave for each number of a shard: byte strings, cut from one run of bytes."""

    def __init__(self, rows: list[tuple[bytes, bytes, bytes]]):
        place = np.concatenate([unzipped(r[0]) for r in rows] or [np.zeros(0, np.uint32)])
        sizes = np.concatenate([unzipped(r[1]) for r in rows] or [np.zeros(0, np.uint32)]).astype(np.int64)
        self.data = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(stretched(r[2]), np.uint8) for r in rows]])
        self.start, self.size = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        self.start[place], self.size[place] = np.cumsum(sizes) - sizes, sizes

    def joined(self, numbers: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The answers of these numbers one after another as items of ``width`` bytes, and the items up to each."""
        return gathered(self.data.view(f"u{width}"), self.start // width, self.size // width, numbers)


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` one after another, and the items up to each run's end (with 0 before)."""
    lengths = size[which]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(ends[-1]) + np.repeat(start[which] - ends[:-1], lengths)
    return flat[at], ends


def by_pieces(data: DataFrame, cutter: Callable, worker: Callable, fold: Callable, schema: str) -> DataFrame:
    """Rows of ``schema`` for all documents of ``data (id, text, ...)``.

    ``cutter()`` gives a function from a text to its pre-tokens and to a number
    of its own; ``worker()`` one from distinct pre-tokens to a byte string each;
    ``fold(columns, extra, counts, numbers, answers)`` makes a record batch of a
    part: its other columns, the cutter's numbers, how many pre-tokens each
    document has, and the pre-tokens' numbers, one document after another.
    """
    n_bytes = data.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-n_bytes // BUCKET_BYTES))
    names, kept = data.columns, [c for c in data.columns if c != "text"]
    at = names.index("text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """``(shard, block, counts, extra, numbers, vocabulary)``; the vocabulary with a shard's last block, else None."""
        from pyspark import TaskContext

        cut, task, order = cutter(), TaskContext.get().partitionId(), itertools.count()
        shard, size, numbers = task << 32 | next(order), 0, defaultdict(itertools.count().__next__)
        for block in blocks(batches, at):
            found, counts, extra = [np.zeros(0, np.uint32)], [], []
            for text in block.column(at):
                text = text.as_py()
                size += len(text)
                count = more = 0
                for pieces, number in cut(text):
                    found.append(np.fromiter(map(numbers.__getitem__, pieces), np.uint32, len(pieces)))
                    count, more = count + len(pieces), more + number
                counts.append(count)
                extra.append(more)
            full = size > SHARD_BYTES or len(numbers) > SHARD_PIECES
            yield shard, block, counts, extra, found, numbers if full else None
            if full:
                shard, size, numbers = task << 32 | next(order), 0, defaultdict(itertools.count().__next__)
        if numbers:
            yield shard, None, [], [], [], numbers

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, _, _, _, _, numbers in shards(batches):
            if numbers:
                lists: list[list[bytes]] = [[] for _ in range(buckets)]
                places: list[list[int]] = [[] for _ in range(buckets)]
                for piece, number in numbers.items():
                    coded = piece.encode()
                    bucket = zlib.crc32(coded) % buckets
                    lists[bucket].append(coded)
                    places[bucket].append(number)
                held = [k for k in range(buckets) if places[k]]
                sizes = [zipped(np.array([len(p) for p in lists[k]])) for k in held]
                columns = [[squeezed(b"".join(lists[k])) for k in held], sizes, [zipped(np.array(places[k])) for k in held]]
                held, columns = [*held, shard % buckets], [[*c, d] for c, d in zip(columns, (None, None, _digest(numbers)), strict=True)]
                yield pa.record_batch([pa.array(held, pa.int32()), pa.array([shard] * len(held), pa.int64()), *[pa.array(c, pa.binary()) for c in columns]], names=["bucket", "shard", "pieces", "sizes", "numbers"])

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do, order, asked = worker(), {}, []
        for batch in batches:
            for shard, pieces, sizes, numbers in zip(*[batch.column(c).to_pylist() for c in ("shard", "pieces", "sizes", "numbers")], strict=True):
                if pieces is None:
                    yield pa.record_batch([pa.array([shard], pa.int64()), *[pa.array([c], pa.binary()) for c in (None, None, numbers)]], names=["shard", "about", "sizes", "numbers"])
                    continue
                pieces, ends = stretched(pieces), np.cumsum(unzipped(sizes), dtype=np.int64).tolist()
                number = order.setdefault
                asked.append((shard, np.array([number(pieces[a:b], len(order)) for a, b in zip([0, *ends[:-1]], ends, strict=True)], np.int64), numbers))
        done: list[bytes] = []
        for some in _portions(list(order)):
            done += do([p.decode() for p in some])
        sizes = np.array([len(d) for d in done], np.int64)
        data, start = np.frombuffer(b"".join(done), np.uint8), np.cumsum(sizes) - sizes
        for shard, pieces, numbers in asked:
            flat, _ = gathered(data, start, sizes, pieces)
            columns = [squeezed(flat.tobytes()), zipped(sizes[pieces]), numbers]
            yield pa.record_batch([pa.array([shard], pa.int64()), *[pa.array([c], pa.binary()) for c in columns]], names=["shard", "about", "sizes", "numbers"])
        asked.clear(), order.clear(), done.clear()
        given_back()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, block, counts, extra, found, numbers in shards(batches):
            if numbers:
                columns = [pa.array([shard], pa.int64()), *[pa.array([c], pa.binary()) for c in (None, None, _digest(numbers))]]
                yield pa.record_batch([*columns, pa.nulls(1, held_type)], names=["shard", "about", "sizes", "numbers", "held"])
            if block is not None:
                held = pa.StructArray.from_arrays([block.column(names.index(c)) for c in kept], names=kept)
                held = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
                columns = [zipped(np.array(extra)), zipped(np.array(counts)), zipped(np.concatenate(found))]
                yield pa.record_batch([pa.array([shard], pa.int64()), *[pa.array([c], pa.binary()) for c in columns], held], names=["shard", "about", "sizes", "numbers", "held"])

    def finish(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, documents, digests = [], [], []
        for batch in batches:
            for k in range(batch.num_rows):
                about, sizes, numbers = [batch.column(c)[k].as_py() for c in ("about", "sizes", "numbers")]
                if about is None:
                    digests.append(numbers)
                elif batch.column("held")[k].is_valid:
                    documents.append((batch.column("held")[k].values, about, sizes, numbers))
                else:
                    answers.append((numbers, sizes, about))
        if len(digests) not in (0, 2) or len(set(digests)) > 1:
            raise RuntimeError("the rows of a partition came in another order; write them to a table first")
        found = Answers(answers)
        answers.clear()
        for held, about, sizes, numbers in documents:
            yield fold({c: held.field(c) for c in kept}, unzipped(about), unzipped(sizes), unzipped(numbers), found)

    held_type = pa.list_(pa.struct([pa.field(c, to_arrow_type(data.schema[c].dataType)) for c in kept]))
    packed = "about binary, sizes binary, numbers binary"
    held = ", ".join(f"`{c}`: {data.schema[c].dataType.simpleString()}" for c in kept)
    asked = data.mapInArrow(ask, "bucket int, shard long, pieces binary, sizes binary, numbers binary")
    answered = asked.groupBy("bucket").applyInArrow(work, f"shard long, {packed}")
    rows = data.mapInArrow(parts, f"shard long, {packed}, held array<struct<{held}>>")
    both = rows.unionByName(answered, allowMissingColumns=True)
    return both.groupBy("shard").applyInArrow(finish, schema)


def _digest(numbers: dict[str, int]) -> bytes:
    """Tells a shard's numbering from another one."""
    return hashlib.md5("\0".join(numbers).encode()).digest()


def _portions(pieces: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of pre-tokens, bounded in number and (but for one of its own) in size."""
    start = held = 0
    for k, piece in enumerate(pieces):
        if k > start and (k - start >= AT_ONCE or held + len(piece) > AT_ONCE_BYTES):
            yield pieces[start:k]
            start, held = k, 0
        held += len(piece)
    if start < len(pieces):
        yield pieces[start:]
