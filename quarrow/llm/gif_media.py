"""Media columns: GIF files as timed frames with colour histograms.

The decoder reads any GIF: it decodes the LZW code streams, applies global and
local palettes, draws frames on the canvas under their disposal and
transparency rules, and gives each frame its time and a colour histogram. The
encoder stores bytes losslessly as palette indices, so that media columns can
be made and read back.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_and_text

#: Samples come in units of so many bytes; a frame holds up to UNITS of them.
UNIT, UNITS, WIDTH = 576, 8, 48
#: Time that each frame is shown.
DELAY_MS = 100
#: Pixels of a canvas or frame, at most: larger ones, which a few bytes can declare, are damage.
MOST_PIXELS = 1 << 25
#: Colours of a histogram: two bits of red, green and blue each.
BINS = 64

_INDEX = np.arange(256)
#: Three bits of red and green and two of blue: every index has its own colour.
PALETTE = np.stack([(_INDEX >> 5) * 36, (_INDEX >> 2 & 7) * 36, (_INDEX & 3) * 85], axis=1).astype(np.uint8)


def _widths(bits: int, count: int) -> np.ndarray:
    """Bits of the codes after a clear code: one more whenever the table outgrows them."""
    size = (1 << bits) + 1 + np.arange(count)
    return np.minimum(np.floor(np.log2(size)).astype(np.int64) + 1, 12)


_WIDTHS = {bits: _widths(bits, 1 << 13) for bits in range(2, 9)}
_STARTS = {bits: np.concatenate([[0], np.cumsum(w)]) for bits, w in _WIDTHS.items()}


def lzw_encode(samples: bytes) -> bytes:
    """Eight-bit samples as an LZW stream, with a clear code whenever the table is full."""
    codes: list[int] = []
    segments: list[list[int]] = []
    table: dict[int, int] = {}
    free, current = 258, -1
    emit, find = codes.append, table.get
    for sample in samples:
        if current < 0:
            current = sample
            continue
        key = current << 8 | sample
        known = find(key)
        if known is not None:
            current = known
            continue
        emit(current)
        current = sample
        table[key] = free
        free += 1
        if free == 4096:
            emit(256)
            segments.append(codes)
            codes = []
            emit = codes.append
            table.clear()
            free = 258
    if current >= 0:
        emit(current)
    emit(257)
    segments.append(codes)
    values = np.array([256, *[c for s in segments for c in s]], dtype=np.int64)
    widths = np.concatenate([[9], *[_WIDTHS[8][: len(s)] for s in segments]])
    return _packed(values, widths)


def _packed(values: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes of given widths, lowest bits first."""
    ends = np.cumsum(widths)
    at = ends - widths
    shifted = values << (at & 7)
    size = int(ends[-1] + 7) >> 3
    lanes = [np.bincount((at >> 3) + k, (shifted >> 8 * k) & 255, size + 3) for k in range(3)]
    return sum(lanes)[:size].astype(np.uint8).tobytes()


def lzw_decode(stream: bytes, bits: int, most: int | None = None) -> bytes:
    """The samples of an LZW stream whose literals have ``bits`` bits, at most ``most``.

    A stream that ends early or holds a code outside the table gives what came
    before it. What is held beyond ``most`` are a table's worth of codes.
    """
    clear, end = 1 << bits, (1 << bits) + 1
    data = np.frombuffer(stream + b"\0\0\0", dtype=np.uint8).astype(np.int64)
    words = data[:-2] | data[1:-1] << 8 | data[2:] << 16
    total, at, held, out = 8 * len(stream), 0, 0, []
    literals = [bytes([k]) for k in range(clear)]
    widths, starts = _WIDTHS[bits], _STARTS[bits]
    while most is None or held < most:
        count = min(int(np.searchsorted(starts, total - at, side="right")) - 1, len(widths))
        if count <= 0:
            break
        places = at + starts[:count]
        codes = words[places >> 3] >> (places & 7) & ((1 << widths[:count]) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else count
        table = [*literals, b"", b""]
        add, part, last, good = table.append, [], b"", True
        for code in codes[:stop].tolist():
            if not last:
                good = code < clear
            elif code > len(table) or (code == len(table) and code == 4096):
                good = False
            if not good:
                break
            entry = table[code] if code < len(table) else last + last[:1]
            if last and len(table) < 4096:
                add(last + entry[:1])
            part.append(entry)
            last = entry
        out.append(b"".join(part))
        held += len(out[-1])
        if not good:
            break
        if stop < count:
            at += int(starts[stop + 1])
            if int(codes[stop]) == end:
                break
        elif count < len(widths):
            break
        else:  # a full table that goes on: nothing is added up to the next clear code
            at += int(starts[count])
            code = clear
            while most is None or held < most:
                places = at + 12 * np.arange(min((total - at) // 12, 4096))
                codes = words[places >> 3] >> (places & 7) & 4095
                stops = np.flatnonzero((codes == clear) | (codes == end) | (codes >= len(table)))
                stop = int(stops[0]) if len(stops) else len(codes)
                out.append(b"".join([table[c] for c in codes[:stop].tolist()]))
                held += len(out[-1])
                at += 12 * min(stop + 1, len(codes))
                code = int(codes[stop]) if stop < len(codes) else -1
                if code >= 0 or not len(codes):
                    break
            if code != clear:
                break
    return b"".join(out)[:most]


def encode(data: bytes) -> bytes:
    """Bytes, in multiples of ``UNIT``, as a GIF of timed frames of palette indices."""
    rows = UNIT // WIDTH
    full = UNIT * UNITS
    height = rows * min(UNITS, len(data) // UNIT)
    parts = [b"GIF89a", struct.pack("<HHBBB", WIDTH, height, 0xF7, 0, 0), PALETTE.tobytes(), b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"]
    for at in range(0, len(data), full):
        samples = data[at : at + full]
        stream = lzw_encode(samples)
        parts.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, DELAY_MS // 10, 0, 0))
        parts.append(struct.pack("<BHHHHBB", 0x2C, 0, 0, WIDTH, len(samples) // WIDTH, 0, 8))
        parts += [bytes([len(part)]) + part for part in (stream[k : k + 255] for k in range(0, len(stream), 255))]
        parts.append(b"\0")
    return b"".join([*parts, b"\x3b"])


@dataclass
class Frame:
    """A frame as drawn: its time, place, own pixels, and the canvas' histogram."""

    start_ms: int
    delay_ms: int
    left: int
    top: int
    width: int
    height: int
    pixels: np.ndarray = field(repr=False)
    histogram: np.ndarray = field(repr=False)


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    """The joined data of sub-blocks, and where they end."""
    parts = []
    while at < len(data) and data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return b"".join(parts), at + 1


def histogram(pixels: np.ndarray) -> np.ndarray:
    top = (pixels >> 6).astype(np.int64)
    return np.bincount((top[..., 0] << 4 | top[..., 1] << 2 | top[..., 2]).ravel(), minlength=BINS)


def _rows(height: int) -> list[int]:
    """Order in which an interlaced frame stores its rows."""
    return [*range(0, height, 8), *range(4, height, 8), *range(2, height, 4), *range(1, height, 2)]


def decode(data: bytes) -> list[Frame]:
    """All frames of a GIF; of a damaged file, those before the damage.

    A frame whose stream ends early is damage, and so is a canvas or frame of more
    than MOST_PIXELS; nothing is allocated for a frame before its samples are there.
    """
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        return []
    width, height, flags, ground, _ = struct.unpack_from("<HHBBB", data, 6)
    at = 13
    common = None
    if flags & 0x80:
        size = 2 << (flags & 7)
        common = np.frombuffer(data[at : at + 3 * size].ljust(3 * size, b"\0"), np.uint8).reshape(size, 3)
        at += 3 * size
    back = common[ground] if common is not None and ground < len(common) else np.zeros(3, np.uint8)
    if width * height > MOST_PIXELS:
        return []
    canvas = None
    frames, clock, control = [], 0, (0, 0, None)
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            label = data[at + 1] if at + 1 < len(data) else 0
            body, at = _blocks(data, at + 2)
            if label == 0xF9 and len(body) >= 4:
                control = (body[0] >> 2 & 7, 10 * (body[1] | body[2] << 8), body[3] if body[0] & 1 else None)
            continue
        if data[at] != 0x2C or at + 11 > len(data):
            break
        left, top, w, h, local = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        palette = common
        if local & 0x80:
            size = 2 << (local & 7)
            palette = np.frombuffer(data[at : at + 3 * size].ljust(3 * size, b"\0"), np.uint8).reshape(size, 3)
            at += 3 * size
        if palette is None or at >= len(data) or not 2 <= data[at] <= 8:
            break
        bits = data[at]
        stream, at = _blocks(data, at + 1)
        held = lzw_decode(stream, bits, w * h) if w * h <= MOST_PIXELS else b""
        if len(held) < w * h or not w * h:
            break
        index = np.frombuffer(held, np.uint8).reshape(h, w)
        if canvas is None:
            canvas = np.empty((height, width, 3), np.uint8)
            canvas[:] = back
        if local & 0x40:
            order = np.empty(h, np.int64)
            order[_rows(h)] = np.arange(h)
            index = index[order]
        disposal, delay, clear = control
        pixels = palette[np.minimum(index, len(palette) - 1)]
        box = (slice(top, min(top + h, height)), slice(left, min(left + w, width)))
        inner = pixels[: max(0, height - top), : max(0, width - left)]
        before = canvas.copy() if disposal == 3 else None
        if clear is None:
            canvas[box] = inner
        else:
            seen = (index != clear)[: inner.shape[0], : inner.shape[1]]
            canvas[box][seen] = inner[seen]
        frames.append(Frame(clock, delay, left, top, w, h, pixels, histogram(canvas)))
        clock += delay
        if disposal == 2:
            canvas[box] = back
        elif disposal == 3:
            canvas = before
        control = (0, 0, None)
    return frames


def samples(frames: list[Frame]) -> bytes:
    """The bytes that :func:`encode` stored, from the colours of the frames."""
    if not frames:
        return b""
    flat = np.concatenate([f.pixels.reshape(-1, 3) for f in frames])
    return (flat[:, 0] // 36 << 5 | flat[:, 1] // 36 << 2 | flat[:, 2] // 85).astype(np.uint8).tobytes()


def padded(data: bytes) -> bytes:
    """The bytes with 255s up to a positive multiple of ``UNIT``."""
    return data.ljust(max(1, -(-len(data) // UNIT)) * UNIT, b"\xff")


FRAMES = "array<struct<start_ms:int,delay_ms:int,left:int,top:int,width:int,height:int,histogram:array<int>>>"
_FRAMES = pa.list_(pa.struct([*[(c, pa.int32()) for c in ("start_ms", "delay_ms", "left", "top", "width", "height")], ("histogram", pa.list_(pa.int32()))]))


def texts_to_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, media)``: every text's UTF-8 bytes, padded, as a GIF.

    Null and empty texts make one unit of padding; very long ones many frames.
    Repeated rows stay repeated, an empty table gives an empty result; extra columns
    are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            media = [encode(padded(t)) for t in block.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([block.column(0), block.column(2), pa.array(media, pa.binary())], names=[id_col, "n_bytes", "media"])

    data = id_and_text(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return data.mapInArrow(run, f"`{id_col}` {data.schema['id'].dataType.simpleString()}, n_bytes long, media binary")


def media_to_frames(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id_col, media, payload, frames)``: timed frames with their histograms.

    ``payload`` is what the frames' colours stand for. Null or damaged media give
    the frames before the damage, if any; media that declare more pixels than
    MOST_PIXELS are damaged. Columns named in ``keep`` go along, repeated rows stay
    repeated, an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            payloads, frames = [], []
            for media in block.column(1).to_pylist():
                found = decode(media or b"")
                payloads.append(samples(found))
                frames.append([{"start_ms": f.start_ms, "delay_ms": f.delay_ms, "left": f.left, "top": f.top, "width": f.width, "height": f.height, "histogram": f.histogram} for f in found])
            more = [block.column(2 + k) for k in range(len(keep))]
            yield pa.record_batch([block.column(0), block.column(1), pa.array(payloads, pa.binary()), pa.array(frames, _FRAMES), *more], names=[id_col, "media", "payload", "frames", *keep])

    data = df.select(F.col(id_col), F.col(media_col).alias("media"), *keep)
    kept = "".join(f", `{c}` {data.schema[c].dataType.simpleString()}" for c in keep)
    return data.mapInArrow(run, f"`{id_col}` {data.schema[id_col].dataType.simpleString()}, media binary, payload binary, frames {FRAMES}{kept}")


def stored_texts(df: DataFrame) -> DataFrame:
    """Digests of what is stored for every document and of what is read back.

    ``feature`` joins the number of frames, their time and the sum of their
    histograms.
    """
    total = F.aggregate("frames", F.array_repeat(F.lit(0), BINS), lambda a, f: F.zip_with(a, f["histogram"], lambda x, y: x + y))
    time = F.aggregate("frames", F.lit(0), lambda a, f: a + f["delay_ms"])
    read = media_to_frames(texts_to_media(df), keep=("n_bytes",))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", F.size("frames"), time, F.array_join(total.cast("array<string>"), ",")).alias("feature"),
    )
