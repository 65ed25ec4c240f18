"""Words of Arrow string blocks as arrays: positions and 64-bit hashes, without loops.

Words are runs of anything but ASCII white space, with A-Z lower-cased for
hashing. UTF-8 continuation bytes are never white space, so bytes suffice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: A random value for every byte, and the base of the hash with its inverse.
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER] * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
#: Bytes of text that are expanded into arrays at a time; longer texts are cut at white space.
SEGMENT = 1 << 18
#: Shingles that are hashed at a time.
SLICE = 1 << 17


def _power(base: int, count: int) -> np.ndarray:
    """1, base, base², ... modulo 2^64."""
    if len(_powers.get(base, ())) < count:
        line = np.full(max(count, SEGMENT + 1), base, dtype=np.uint64)
        line[0] = 1
        line = np.multiply.accumulate(line)
        if count > 4 * SEGMENT:  # of a text without white space; not kept
            return line[:count]
        _powers[base] = line
    return _powers[base][:count]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """``starts`` and ``ends`` index ``data``; document ``d`` has the words ``first[d]`` to ``first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """The words of a block of texts, document by document; null texts have none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[data]
    begin = inside[1:-1] & ~inside[:-2]
    stop = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begin[edges] = inside[edges + 1]
    stop[edges - 1] = inside[edges]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * _power(_BASE, n), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts]
    return Words(data, starts, ends, np.searchsorted(starts, offsets), mixed(hashes ^ (ends - starts).astype(np.uint64)))


def segments(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """``(index, texts)``: runs of whole texts of about SEGMENT bytes, from that index on.

    A longer text comes in parts with the same index, cut behind white space where it has any.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    sizes = pc.binary_length(texts).to_pylist()
    start = held = 0
    for k, size in enumerate([*sizes, SEGMENT + 1]):
        if held + size > SEGMENT and k > start:
            yield start, texts[start:k]
            start, held = k, 0
        if size > SEGMENT and k < len(sizes):
            data = np.frombuffer(texts[k].as_buffer(), np.uint8)
            at = 0
            while at < size:
                end = at + SEGMENT
                while end < size:
                    gaps = np.flatnonzero(_SPACE[data[at:end][-SEGMENT:]])
                    if len(gaps):
                        end += int(gaps[-1]) + 1 - min(SEGMENT, end - at)
                        break
                    end += SEGMENT
                end = min(end, size)
                yield k, pa.array([data[at:end].tobytes()], pa.large_binary())
                at = end
            start, held = k + 1, 0
        else:
            held += size


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)`` as in :class:`Words`, of texts of any length, a segment at a time."""
    found, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for index, part in segments(texts):
        words = words_of(part)
        found.append(words.hashes)
        counts[index : index + len(part)] += np.diff(words.first)
    return np.concatenate(found), np.concatenate([[0], np.cumsum(counts)])


def shingles(hashes: np.ndarray, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: each document's runs of ``width`` words, in order.

    ``words`` says where each document's word hashes begin. A document with fewer
    words has its whole sequence as the one shingle; one without words has none.
    """
    counts = np.diff(words)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    padded = np.append(hashes, np.zeros(width, np.uint64))
    out = np.zeros(first[-1], dtype=np.uint64)
    for low in range(0, len(out), SLICE):
        place = np.arange(low, min(low + SLICE, len(out)))
        document = np.searchsorted(first, place, side="right") - 1
        at, end = place + (words[:-1] - first[:-1])[document], words[1:][document]
        h = np.zeros(len(place), dtype=np.uint64)
        for k in range(width):
            there = at + k < end
            h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + np.where(there, padded[at + k], np.uint64(0)) + np.uint64(k + 1) * there.astype(np.uint64))
        out[low : low + len(place)] = h
    return out, first


def distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct hashes in ascending order, and where they lie."""
    if len(first) == 2:
        h = np.unique(h)
        return h, np.array([0, len(h)])
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(first) - 1))])
