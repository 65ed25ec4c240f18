"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The corpus's distinct pre-tokens are gathered in buckets, each in one place
(:mod:`.pieces`), and replayed there once. All pre-tokens of a bucket's portion
lie in one flat chain of tokens, and an inverted index maps the rank of every
token pair to the positions where the pair stands. Merges are then replayed over
the whole chain in rank order; a merge looks only at its two neighbours and files
the pairs it creates under their own ranks. The ids come back to the documents,
which hold their pre-tokens as numbers.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_and_text
from .pieces import Answers, by_pieces, gathered, parts_of

#: From this length on a word has too many merges of its own to wait for others.
LONG_WORD = 256
#: Windows of rising rank in the inverted index.
WINDOWS = 12


@functools.lru_cache(maxsize=4)
def tokens_of(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank; a worker reads it once."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (max([int(rank) for _, rank in pairs], default=-1) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Ranks:
    """A rank file's tokens, and the rank of every mergeable pair."""

    def __init__(self, path: str):
        self.token = tokens_of(path)
        self.width = len(self.token)
        rank = {token: k for k, token in enumerate(self.token) if token}
        self.byte = [rank[bytes([b])] for b in range(256)]
        self.first = np.array(self.byte, dtype=np.int64)
        keys, values = [], []
        for token, merged in rank.items():
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    values.append(merged)
        order = np.argsort(np.array(keys or [-1], dtype=np.int64))
        self.keys = np.array(keys or [-1], dtype=np.int64)[order]
        self.values = np.array(values or [-1], dtype=np.int64)[order]

    @functools.cached_property
    def pair(self) -> dict[int, int]:
        """Ranks by pair for single look-ups, which only long words need."""
        return dict(zip(self.keys.tolist(), self.values.tolist(), strict=True))

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to, or -1."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], -1)


@functools.lru_cache(maxsize=4)
def ranks_of(path: str) -> Ranks:
    """A worker reads a rank file once."""
    return Ranks(path)


def replay(words: list[bytes], ranks: Ranks) -> list[bytes]:
    """Packed token ids of each word, by one replay of the merges over all of them.

    The words are one flat chain. The index holds (rank, position) of every
    mergeable pair, cut into windows of rising rank; a window is worked off
    before the next is opened. Within a window each word gives its lowest pair
    (the leftmost of equals), so every word sees its merges in rank order even
    where a merge makes a pair of a lower rank. A merge looks only at the pairs
    it forms with its two neighbours and files them in their window. Entries
    whose tokens have changed meanwhile are dropped when they come up.
    """
    if not words:
        return []
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    token = ranks.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    n = len(token)
    word = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
    after = np.arange(1, n + 1, dtype=np.int64)
    before = np.arange(-1, n - 1, dtype=np.int64)
    at = np.flatnonzero(word[:-1] == word[1:])
    entry = _entries(at, token[at], token[at + 1], ranks)
    entry = entry[:, np.argsort(entry[0], kind="stable")]
    bounds = np.unique(entry[0][:: max(1, entry.shape[1] // WINDOWS)])[1:]  # first rank of each window but the first
    cuts = [0, *np.searchsorted(entry[0], bounds).tolist(), entry.shape[1]]
    index = [[entry[:, a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for window in range(len(index)):
        limit = bounds[window] if window < len(bounds) else ranks.width
        while index[window]:
            rank, pos, left, right = entry = np.concatenate(index[window], axis=1)
            index[window] = []
            same = (token[pos] == left) & (token[np.minimum(after[pos], n - 1)] == right)
            if not same.all():
                rank, pos, left, right = entry = entry[:, same]
            if not len(pos):
                continue
            order = np.lexsort((pos, rank, word[pos]))
            owner = word[pos[order]]
            lead = np.ones(len(order), dtype=bool)
            lead[1:] = owner[1:] != owner[:-1]
            if not lead.all():
                index[window].append(entry[:, order[~lead]])
            lead = order[lead]
            pos, rank = pos[lead], rank[lead]
            gone = after[pos]
            follow = after[gone]
            token[pos] = rank
            token[gone] = -1
            after[pos] = follow
            inner = follow < n
            before[follow[inner]] = pos[inner]
            inner &= word[np.minimum(follow, n - 1)] == word[pos]
            ahead = before[pos]
            outer = (ahead >= 0) & (word[ahead] == word[pos])
            new = _entries(
                np.concatenate([pos[inner], ahead[outer]]),
                np.concatenate([token[pos[inner]], token[ahead[outer]]]),
                np.concatenate([token[follow[inner]], token[pos[outer]]]),
                ranks,
            )
            soon = new[0] < limit
            if soon.any():
                index[window].append(new[:, soon])
            if not soon.all():
                new = new[:, ~soon]
                place = np.searchsorted(bounds, new[0], side="right")
                order = np.argsort(place, kind="stable")
                for k, part in zip(*_groups(place[order]), strict=True):
                    index[k].append(new[:, order[part]])
    alive = token >= 0
    packed = token[alive].astype("<u4").tobytes()
    ends = (np.cumsum(np.bincount(word[alive], minlength=len(words))) * 4).tolist()
    return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _entries(pos: np.ndarray, left: np.ndarray, right: np.ndarray, ranks: Ranks) -> np.ndarray:
    """Rows rank, position, left and right token of the pairs that merge."""
    rank = ranks.of_pairs(left, right)
    return np.stack([rank, pos, left, right])[:, rank >= 0]


def _groups(ordered: np.ndarray) -> tuple[list[int], list[slice]]:
    """Distinct values of an ordered array, and where each lies."""
    values, starts = np.unique(ordered, return_index=True)
    ends = [*starts[1:].tolist(), len(ordered)]
    return values.tolist(), [slice(a, b) for a, b in zip(starts.tolist(), ends, strict=True)]


def replay_long(words: list[bytes], ranks: Ranks) -> list[bytes]:
    """As :func:`replay`, position by position: for words of any length.

    A rank is taken from the index with all its positions. Where a merge makes a
    pair of a lower rank, that pair comes first within its word, so the word's
    remaining positions are filed again. Equal ranks merge from left to right.
    """
    if not words:
        return []
    width, find = ranks.width, ranks.pair.get
    byte = ranks.byte
    token: list[int] = [-1]
    start = []
    for word in words:
        start.append(len(token))
        token.extend([byte[b] for b in word])
        token.append(-1)
    size = len(token)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    index: dict[int, list[int]] = {}
    flat = np.array(token, dtype=np.int64)
    keys = (flat[:-1] * width + flat[1:]).tolist()
    solid = ((flat[:-1] >= 0) & (flat[1:] >= 0)).tolist()
    for at, key in enumerate(keys):
        if solid[at]:
            rank = find(key)
            if rank is not None:
                if rank in index:
                    index[rank].append(at)
                else:
                    index[rank] = [at]
    queue = list(index)
    heapq.heapify(queue)
    heap_push, heap_pop = heapq.heappush, heapq.heappop
    ends = None
    while queue:
        rank = heap_pop(queue)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        held_from = -1  # positions up to here wait for a lower rank of their word
        for at in places:
            left = token[at]
            if left < 0 or at <= held_from:
                if left >= 0:
                    if rank not in index:
                        index[rank] = []
                        heap_push(queue, rank)
                    index[rank].append(at)
                continue
            there = after[at]
            right = token[there]
            if right < 0 or find(left * width + right) != rank:
                continue
            token[at] = rank
            token[there] = -2
            follow = after[there]
            after[at] = follow
            before[follow] = at
            lowest = rank
            last = token[follow]
            if last >= 0:
                new = find(rank * width + last)
                if new is not None:
                    if new in index:
                        index[new].append(at)
                    else:
                        index[new] = [at]
                        heap_push(queue, new)
                    lowest = min(lowest, new)
            ahead = before[at]
            first = token[ahead]
            if first >= 0:
                new = find(first * width + rank)
                if new is not None:
                    if new in index:
                        index[new].append(ahead)
                    else:
                        index[new] = [ahead]
                        heap_push(queue, new)
                    lowest = min(lowest, new)
            if lowest < rank:
                if ends is None:
                    ends = np.array([s + len(w) for s, w in zip(start, words, strict=True)])
                held_from = int(ends[np.searchsorted(ends, at, side="right")])
    out = []
    for at, word in zip(start, words, strict=True):
        end = at + len(word)
        ids = []
        while at < end:
            ids.append(token[at])
            at = after[at]
        out.append(np.array(ids, dtype="<u4").tobytes())
    return out


class Encoder:
    """Cuts texts and encodes pre-tokens; a Python worker keeps one for all its tasks."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks, self.pieces = ranks_of(path), regex.compile(pattern).findall

    def cut(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Pre-tokens, part by part."""
        for part in parts_of(text, _between_words):
            yield self.pieces(part), 0

    def code(self, pieces: list[str]) -> list[bytes]:
        """Each pre-token's ids, packed as little-endian unsigned 32-bit integers."""
        coded = [w.encode() for w in pieces]
        short = [w for w in coded if len(w) < LONG_WORD]
        long = [w for w in coded if len(w) >= LONG_WORD]
        found = dict(zip(short, replay(short, self.ranks), strict=True)) | dict(zip(long, replay_long(long, self.ranks), strict=True))
        return [found[w] for w in coded]

    def block(self, texts: list[str]) -> list[bytes]:
        """Each text's packed ids, without the exchange: for a few texts."""
        words = [[piece for part, _ in self.cut(text) for piece in part] for text in texts]
        distinct = list(set().union(*words))
        ids = dict(zip(distinct, self.code(distinct), strict=True))
        return [b"".join([ids[w] for w in pieces]) for pieces in words]


_GAP = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def _between_words(text: str, at: int) -> int:
    """The first place from ``at`` on before a single space between two words; pre-tokens begin there."""
    found = _GAP.search(text, at)
    return found.start() if found else len(text)


@functools.lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _by_pieces(df: DataFrame, path: str, pattern: str, id_col: str, text_col: str, back: bool) -> DataFrame:
    """``(id_col, ids)``, with the ``bytes`` that they decode to where ``back`` is asked for."""

    def cutter():
        return encoder_of(path, pattern).cut

    def worker():
        return encoder_of(path, pattern).code

    def fold(columns: dict[str, pa.Array], _: np.ndarray, counts: np.ndarray, numbers: np.ndarray, answers: Answers) -> pa.RecordBatch:
        ids, ends = answers.joined(numbers, 4)
        ends = ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        out = [columns["id"], _cut(ids.astype("<u4", copy=False), ends)]
        if back:
            token = bytes_of(path)
            data, marks = gathered(token.flat, token.start, token.size, ids)
            out.append(_cut(data, marks[ends]))
        return pa.record_batch(out, names=[id_col, "ids", "bytes"][: len(out)])

    data = id_and_text(df, id_col, text_col)
    schema = f"`{id_col}` {data.schema['id'].dataType.simpleString()}, ids binary" + ", bytes binary" * back
    return by_pieces(data, cutter, worker, fold, schema)


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values from one run of numbers."""
    wide = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))])
    return wide.cast(pa.binary())


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)``: whole texts as packed little-endian unsigned 32-bit ids.

    ``path`` is the rank file on every executor, ``pattern`` the pre-token
    pattern; no special tokens. Null or empty text: empty ``ids``. Very long texts
    are cut in parts before a space between two words, where no pre-token of a
    pattern spans that takes a space only before a word. Repeated rows stay
    repeated, an empty table gives an empty result; extra columns are dropped.
    """
    return _by_pieces(df, path, pattern, id_col, text_col, back=False)


class Bytes:
    """The byte strings of a rank file as one run of bytes."""

    def __init__(self, path: str):
        token = tokens_of(path)
        self.flat = np.frombuffer(b"".join(token), np.uint8)
        self.size = np.array([len(t) for t in token], np.int64)
        self.start = np.cumsum(self.size) - self.size


@functools.lru_cache(maxsize=4)
def bytes_of(path: str) -> Bytes:
    return Bytes(path)


def decoded(ids: bytes, token: list[bytes]) -> bytes:
    """The byte string that packed ids stand for."""
    return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, ids, bytes)``: the packed ids and the byte strings they stand for.

    Null ids: null bytes. An id outside the rank file raises ``IndexError``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens_of(path)
        for block in blocks(batches):
            texts = [None if ids is None else decoded(ids, token) for ids in block.column(1).to_pylist()]
            yield pa.record_batch([block.column(0), block.column(1), pa.array(texts, pa.binary())], names=[id_col, "ids", "bytes"])

    data = df.select(F.col(id_col), F.col(ids_col).alias("ids"))
    return data.mapInArrow(run, f"`{id_col}` {data.schema[id_col].dataType.simpleString()}, ids binary, bytes binary")


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of encoding and decoding."""
    return tokenised(df, path, pattern, id_col, text_col).drop("ids")


def tokenised(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`round_trip`, with the packed ``ids``; both ways in one pass of one worker."""
    both = _by_pieces(df, path, pattern, id_col, text_col, back=True)
    return both.select(
        F.col(id_col),
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
