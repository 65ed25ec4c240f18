"""Repeated byte windows by a depth-limited most-significant-digit radix sort.

Suffixes matter only through their first LENGTH bytes: groups that are equal to
that depth are exactly the repeated windows. Passes refine groups by ever more
bytes, and retire what is decided:

* pass 1: the digit is a window's smallest DIGIT-byte string (by hash, leftmost
  of equals). Equal windows share it, and neighbouring windows mostly do, so a
  *part* - a run of windows with one such place - enters as a single row;
* pass 2: parts in groups with others are cut into eighths; the digit is all
  that the windows of an eighth have in common;
* pass 3: what is left is compared window by window, at full depth.

In each pass a group of one is unique, and parts whose whole extents are equal
are repeated as a whole; both retire. Only parts that share the digit, but not
the extent, go on, with one witness of every repeated extent in their group.

Blocks of documents are added up before they are shuffled, so that copies in
any number come to a row for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, dropped, written
from .words import SEGMENT, _power, mixed

#: Bytes of the first digit, and windows in a piece of the second pass.
DIGIT, PIECE = 64, 17

_RANDOM = np.random.default_rng(1729)
_VALUES = [_RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)

PARTS = "core long, extent long, row long, low int, high int, place int, weight long"
_FIELDS = ("core", "extent", "row", "low", "high", "place", "weight")


class Bytes:
    """The texts of a block as one run of bytes, with hashes of any span of it.

    ``shift``: where they begin in their text, of a part of a long one.
    """

    def __init__(self, rows: pa.Array, texts: pa.Array, shift: int = 0):
        self.shift = shift
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        self.data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.rows = rows.to_numpy(zero_copy_only=False)
        self._sums: dict[int, np.ndarray] = {}

    def span(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One of two independent hashes of the bytes from ``start`` to ``end``."""
        n = len(self.data)
        if which not in self._sums:
            self._sums[which] = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_VALUES[which][self.data] * _power(_BASES[which], n), out=self._sums[which][1:])
        sums = self._sums[which]
        return mixed((sums[end] - sums[start]) * _power(_INVERSES[which], n + 1)[start])


def _whole(blocks_of: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, Bytes, int, int]]:
    """``(block, text, first, last)``: blocks, or parts of a long text in which those windows start.

    A part goes on for as long as the windows that start in it, and their digits, do.
    """
    for block in blocks_of:
        size = len(block.column(1)[0].as_buffer()) if block.num_rows == 1 else 0
        if size <= 2 * SEGMENT:
            yield block, Bytes(block.column(0), block.column(1)), 0, size
            continue
        held = np.frombuffer(block.column(1)[0].as_buffer(), np.uint8)
        for first in range(0, max(1, size - length + 1), SEGMENT):
            low, high = max(0, first - length), min(size, first + SEGMENT + 2 * length)
            part = pa.array([held[low:high].tobytes()], pa.large_binary())
            yield block, Bytes(block.column(0), part, low), first, min(size, first + SEGMENT)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` neighbours is, the leftmost of equals."""
    at = np.arange(len(values), dtype=np.int32)
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


def _parts(text: Bytes, length: int, first: int, last: int) -> dict[str, np.ndarray]:
    """Pass 1: runs of windows with one smallest digit; places count from the block's start.

    Of a part of a long text, those windows that start from ``first`` to before ``last``.
    """
    n = len(text.data)
    if n < length:
        return {c: np.zeros(0, np.int64) for c in _FIELDS}
    digits = text.span(0, np.arange(n - DIGIT + 1), np.arange(DIGIT, n + 1))
    place = _smallest(digits, length - DIGIT + 1)
    document = np.repeat(np.arange(len(text.rows)), np.diff(text.offsets))[: len(place)]
    start = np.flatnonzero(np.arange(len(place)) + length <= text.offsets[document + 1])
    if len(text.rows) == 1:
        start = start[(start + text.shift >= first) & (start + text.shift < last)]
    document, at = document[start], place[start].astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (document[1:] != document[:-1])
    heads = np.flatnonzero(new)
    low = start[heads]
    high = start[np.append(heads[1:], len(start)) - 1] if len(heads) else low
    return _rows(text, document[heads], digits[at[heads]], at[heads], low, high, length)


def _rows(text: Bytes, document: np.ndarray, core: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Parts as rows; offsets count from their documents' starts."""
    extent = mixed(text.span(1, low, high + length) ^ ((place - low).astype(np.uint64) << np.uint64(32)) ^ (high - low).astype(np.uint64))
    base = text.offsets[document] - text.shift
    weight = np.ones(len(low), np.int64) if weight is None else weight
    return dict(zip(_FIELDS, (core.view(np.int64), extent.view(np.int64), text.rows[document], low - base, high - base, place - base, weight), strict=True))


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
    return pa.record_batch([pa.array(columns[c], k) for c, k in zip(_FIELDS, kinds, strict=True)], names=list(_FIELDS))


def _added(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Parts of equal extent as one, with their number; the first stands for all."""
    order = np.lexsort((columns["extent"], columns["core"]))
    core, extent = columns["core"][order], columns["extent"][order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (core[1:] != core[:-1]) | (extent[1:] != extent[:-1])
    heads = np.flatnonzero(new)
    out = {c: v[order[heads]] for c, v in columns.items()}
    out["weight"] = np.add.reduceat(columns["weight"][order], heads) if len(heads) else columns["weight"]
    return out


def _judged(parts: DataFrame) -> DataFrame:
    """``(core, extent, n, extents, row, place)`` of groups with more than one member.

    ``n`` counts an extent, ``extents`` those of its group; row and place name a witness.
    """
    group = Window.partitionBy("core")
    counted = parts.repartition("core").groupBy("core", "extent").agg(F.sum("weight").alias("n"), F.min(F.struct("row", "low", "place")).alias("witness"))
    total = counted.withColumn("all", F.sum("n").over(group)).withColumn("extents", F.count("*").over(group))
    return total.where("all > 1").drop("all")


def _settled(parts: DataFrame, judged: DataFrame) -> DataFrame:
    """``(row, low, high, place, weight, repeated, on)`` of parts in groups.

    ``repeated``: the extent occurs twice or more. ``on``: the part goes on to the
    next pass, with ``weight`` occurrences.
    """
    known = parts.drop("weight").join(judged, ["core", "extent"])
    stands = F.struct("row", "low", "place") == F.col("witness")
    return known.select("row", "low", "high", "place", F.col("n").alias("weight"), (F.col("n") > 1).alias("repeated"), ((F.col("extents") > 1) & ((F.col("n") == 1) | stands)).alias("on"))


def _refined(base: DataFrame, settled: DataFrame, cut: Callable, length: int) -> DataFrame:
    """Parts that go on, cut into smaller ones where their texts are."""
    lists = settled.where("on").groupBy("row").agg(F.collect_list(F.struct("low", "high", "place", "weight")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, text, first, last in _whole(blocks(batches, limit=SEGMENT), length):
            lists = block.column(2)
            document = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            low, high, place, weight = [flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)]
            if len(lists) == 1:  # a part's windows start in it, or end a run that does
                held = (low >= first) & (low < last)
                document, low, high, place, weight = document[held], low[held], high[held], place[held], weight[held]
            base = text.offsets[document] - text.shift
            yield _batch(cut(text, document, low + base, high + base, place + base, weight))

    return base.select("row", "text").join(lists, "row").mapInArrow(run, PARTS)


def _pieces(length: int) -> Callable:
    """Pass 2: eighths, placed relative to the digit, and what their windows have in common."""

    def cut(text, document, low, high, place, weight):
        out = []
        for piece in range(-(-(length - DIGIT + 1) // PIECE)):
            upper = place - piece * PIECE  # the last window's start, were all of the piece's windows there
            lower = upper - PIECE + 1
            a, b = np.maximum(low, lower), np.minimum(high, upper)
            k = np.flatnonzero(a <= b)
            core = mixed(text.span(0, upper[k], lower[k] + length) + np.uint64(piece))
            out.append(_rows(text, document[k], core, place[k], a[k], b[k], length, weight[k]))
        return {c: np.concatenate([o[c] for o in out]) for c in _FIELDS}

    return cut


def _windows(length: int) -> Callable:
    """Pass 3: single windows."""

    def cut(text, document, low, high, place, weight):
        count = high - low + 1
        owner = np.repeat(np.arange(len(low)), count)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + low[owner]
        core = text.span(0, start, start + length)
        return _rows(text, document[owner], core, place[owner], start, start, length, weight[owner])

    return cut


def repeats(base: DataFrame, length: int) -> DataFrame:
    """``(row, low, high)``: runs of starts of repeated windows, from ``base (row, text)``."""

    def first(add: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, text, low, high in _whole(blocks(batches, limit=SEGMENT), length):
                found = _parts(text, length, low, high)
                yield _batch(_added(found) if add else found)

        return base.select("row", "text").mapInArrow(run, PARTS)

    judged = written(_judged(first(add=True)), "suffix-groups")
    found, tables = [], []
    settled = written(_settled(first(add=False), judged), "suffix-parts")
    dropped(judged)
    for cut in (_pieces(length), _windows(length)):
        found.append(settled.where("repeated").select("row", "low", "high"))
        parts = written(_refined(base, settled, cut, length), "suffix-finer")
        judged = written(_judged(parts), "suffix-groups")
        settled = written(_settled(parts, judged), "suffix-parts")
        tables += [parts, judged]
    found.append(settled.where("repeated").select("row", "low", "high"))
    for table in tables:
        dropped(table)
    return found[0].union(found[1]).union(found[2])


def _merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch as one, in order."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.append(True, low[1:] > reach[:-1])
    return low[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]


def deduplicated(df: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept)`` of every row.

    A byte goes if a string of ``length`` bytes that also starts anywhere else, in
    this or another row, covers it; overlapping occurrences count, and all is
    judged on the input. ``kept`` holds the other bytes; cuts can fall inside
    characters. Null and empty texts have nothing to remove. Rows that repeat a
    text of ``length`` bytes or more lose all of it; an empty table gives an empty
    result. Very long texts are worked on a segment at a time. ``length`` must be
    greater than ``DIGIT``.
    """
    if length <= DIGIT:
        raise ValueError(f"length must be greater than {DIGIT}")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = written(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text.alias("text")), "suffix-texts")
    lists = repeats(base, length).groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            removed, spans, kept = [], [], []
            for text, runs in zip(block.column(1), block.column(2), strict=True):
                data = text.as_py()
                if not runs.is_valid:
                    removed.append(0), spans.append(0), kept.append(data)
                    continue
                low, high = [runs.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)]
                low, high = _merged(low, high + length)
                removed.append(int((high - low).sum()))
                spans.append(len(low))
                kept.append(b"".join([data[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(data)], strict=True)]))
            sizes = pc.binary_length(block.column(1)).cast(pa.int64())
            yield pa.record_batch([block.column(0), sizes, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    rows = base.join(lists, "row", "left").select("id", "text", "runs")
    return rows.mapInArrow(run, f"`{id_col}` {base.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary")


def removed_repeats(df: DataFrame) -> DataFrame:
    """What is removed of every document, and a digest of what is kept."""
    return deduplicated(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The same by hashing every string of 200 bytes, for an engine without this module and small tables.
ORACLE_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT k, p, md5(substr(h, 2 * p + 1, 400)) AS m FROM (SELECT k, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM texts)
), repeated AS (
  SELECT k, p FROM windows WHERE m IN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1)
), runs AS (
  SELECT k, min(p) AS low, max(p) + 200 AS high FROM (SELECT k, p, sum(opens) OVER (PARTITION BY k ORDER BY p) AS run FROM (SELECT k, p, CASE WHEN p - lag(p) OVER (PARTITION BY k ORDER BY p) <= 200 THEN 0 ELSE 1 END AS opens FROM repeated)) GROUP BY k, run
), gaps AS (
  SELECT k, lag(high, 1, 0) OVER (PARTITION BY k ORDER BY low) AS a, low AS b FROM runs
  UNION ALL SELECT r.k, max(r.high), max(length(h) // 2) FROM runs r JOIN texts USING (k) GROUP BY r.k
), kept AS (
  SELECT g.k, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gaps g JOIN texts USING (k) GROUP BY g.k
), spans AS (
  SELECT k, count(*) AS n_spans FROM runs GROUP BY k
)
SELECT t.doc_id, CAST(length(t.h) // 2 AS BIGINT) AS n_bytes, CAST((length(t.h) - length(coalesce(kept.h, t.h))) // 2 AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN kept USING (k) LEFT JOIN spans USING (k)
"""
