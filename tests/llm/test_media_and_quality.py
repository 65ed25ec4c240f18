from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrow.llm import gif_media, quality, words

from ..conftest import DATA
from .conftest import pairs


@given(st.binary(max_size=3000))
@settings(max_examples=60, deadline=None)
def test_lzw_round_trip(data):
    assert gif_media.lzw_decode(gif_media.lzw_encode(data), 8) == data


@pytest.mark.parametrize("size", [3838, 5000, 20_000])
def test_lzw_with_full_tables(size):
    for data in (random.Random(size).randbytes(size), bytes(size), b"ab" * size):
        assert gif_media.lzw_decode(gif_media.lzw_encode(data), 8) == data


def test_known_stream():
    # A published ten by ten sample of four colours.
    stream = bytes.fromhex("8c2d99872a1cdc33a0027 5ec95faa8de608c04914c01".replace(" ", ""))
    top = [1, 1, 1, 1, 1, 2, 2, 2, 2, 2]
    mid = [1, 1, 1, 0, 0, 0, 0, 2, 2, 2]
    low = [2, 2, 2, 0, 0, 0, 0, 1, 1, 1]
    want = top * 3 + mid * 2 + low * 2 + [2, 2, 2, 2, 2, 1, 1, 1, 1, 1] * 3
    assert list(gif_media.lzw_decode(stream, 2)) == want


def gif(frames, size=(2, 2), palette=((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))):
    """A GIF of literal codes: frames are (samples, box, disposal, delay, transparent)."""
    out = [b"GIF89a", struct.pack("<HHBBB", *size, 0x81, 0, 0), bytes(v for c in palette for v in c)]
    for samples, box, disposal, delay, clear in frames:
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (clear is not None), delay, clear or 0, 0))
        codes = [c for s in samples for c in (4, s)] + [5]
        stream = gif_media._packed(np.array(codes), np.full(len(codes), 3))
        out += [struct.pack("<BHHHHBB", 0x2C, *box, 0, 2), bytes([len(stream)]), stream, b"\0"]
    return b"".join([*out, b"\x3b"])


def colours(frame):
    return {int(k): int(v) for k, v in enumerate(frame.histogram) if v}


def test_disposal_transparency_and_time():
    black, red, green = 0, 3 << 4, 3 << 2
    frames = gif_media.decode(gif([([1, 1, 1, 1], (0, 0, 2, 2), 1, 5, None), ([2], (0, 0, 1, 1), 3, 7, None), ([2, 0], (0, 1, 2, 1), 2, 1, 0), ([1], (0, 0, 1, 1), 0, 1, 1)]))
    assert [(f.start_ms, f.delay_ms) for f in frames] == [(0, 50), (50, 70), (120, 10), (130, 10)]
    assert [colours(f) for f in frames] == [{red: 4}, {red: 3, green: 1}, {red: 3, green: 1}, {black: 2, red: 2}]


def test_damaged_media():
    whole = gif_media.encode(bytes(range(256)) * 9)
    assert gif_media.samples(gif_media.decode(whole)) == bytes(range(256)) * 9
    for cut in (0, 5, 12, 20, 900, len(whole) // 2):
        gif_media.decode(whole[:cut])
    assert gif_media.decode(b"no image") == []
    cut = gif([([1, 1, 1, 1], (0, 0, 2, 2), 1, 5, None), ([1, 2], (0, 0, 2, 2), 1, 5, None)])
    assert len(gif_media.decode(cut)) == 1  # the second frame holds two of its four samples


def test_declared_sizes_take_no_memory():
    start = time.monotonic()
    assert gif_media.decode(gif([([1], (0, 0, 1, 1), 0, 1, None)], size=(65535, 65535))) == []
    assert gif_media.decode(gif([([1], (0, 0, 65535, 65535), 0, 1, None)], size=(2, 2))) == []
    # A table that fills up with ever longer runs, and then repeats the longest.
    segment = [256, 0, *range(258, 4096), *[4095] * 6000]
    widths = np.concatenate([[12], gif_media._WIDTHS[8][:3839], np.full(6000, 12)])
    values, widths = np.array(segment * 30), np.tile(widths, 30)
    widths[0] = 9
    assert gif_media.lzw_decode(gif_media._packed(values, widths), 8, 1000) == bytes(1000)
    two = 2 * len(segment)
    assert len(gif_media.lzw_decode(gif_media._packed(values[:two], widths[:two]), 8)) == 2 * (sum(range(1, 3840)) + 6000 * 3839)
    assert time.monotonic() - start < 20


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_texts_stored_as_media(which, request):
    df = request.getfixturevalue(which)
    want = Counter()
    for key, text in pairs(df):
        data = text.encode()
        payload = data + b"\xff" * (-len(data) % 576 if data else 576)
        want[key, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])] += 1
    rows = gif_media.stored_texts(df).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    assert all(r["media_bytes"] > 0 and r["feature"].count(",") == 63 for r in rows)
    assert len({r["payload_sha256"] for r in rows}) == len({r["media_sha256"] for r in rows})


def test_words_are_those_of_the_pattern():
    rng = random.Random(4)
    texts = ["".join(rng.choices(["a", "B", " ", "\n", "é", "\t\t", "😀", "word", "\x85", "\xa0"], k=rng.randint(0, 12))) for _ in range(2000)] + [None, "", " "]
    found = words.words_of(pa.array(texts))
    sets, first = words.distinct(*words.shingles(found.hashes, found.first, 3))
    seen = {}
    for k, text in enumerate(texts):
        plain = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        assert found.first[k + 1] - found.first[k] == len(plain)
        hashes = found.hashes[found.first[k] : found.first[k + 1]].tolist()
        for word, h in zip(plain, hashes, strict=True):
            assert seen.setdefault(word, h) == h
        grams = {tuple(plain[j : j + 3]) for j in range(len(plain) - 2)} or ({tuple(plain)} if plain else set())
        assert first[k + 1] - first[k] == len(grams)
    assert len(set(seen.values())) == len(seen) and len(sets) == first[-1]


@pytest.mark.parametrize("segment", [64, 1 << 18])
def test_segments_change_no_word(segment, monkeypatch):
    monkeypatch.setattr(words, "SEGMENT", segment)
    rng = random.Random(12)
    texts = ["".join(rng.choices(["a", "bb ", " \n", "é", "wörd "], k=rng.randint(0, 200))) for _ in range(50)] + [None, "", "x" * 500, "y" * 100 + " z"]
    whole = words.words_of(pa.array(texts))
    hashes, first = words.word_hashes(pa.array(texts))
    assert hashes.tolist() == whole.hashes.tolist() and first.tolist() == whole.first.tolist()
    found = [Counter() for _ in texts]
    for bucket, owner in quality.grams(pa.array(texts)):
        for b, o in zip(bucket.tolist(), owner.tolist(), strict=True):
            found[o][b] += 1
    assert found == [Counter(g) for g in by_hand(texts)]


def by_hand(texts):
    """Buckets of every n-gram of each text, word by word."""
    mix = lambda k: int(words.mixed(np.array([k % (1 << 64)], np.uint64))[0])
    out = []
    for text in texts:
        found = words.words_of(pa.array([text]))
        raw = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        shapes, before = [], None
        for word in raw:
            kinds = [next((k + 1 for k, of in enumerate((range(97, 123), range(65, 91), range(48, 58), range(128, 256))) if b in of), 0) for b in word]
            shape = min(kinds.count(0), 3)
            low = word.translate(bytes(b + 32 if 65 <= b < 91 else b for b in range(256)))
            for part, width in ((1 in kinds, 2), (min(kinds.count(2), 2), 3), (3 in kinds, 2), (sum(len(word) > n for n in (2, 4, 8, 16)), 5), (word[-1] if not kinds[-1] else 0, 256), (low == before, 2)):
                shape = shape * width + int(part)
            shapes.append(mix(shape + 1))
            before = low
        pairs_ = [mix(a * 31 + b) for a, b in zip(shapes, shapes[1:])]
        out.append([h % quality.BUCKETS for h in (*found.hashes.tolist(), *shapes, *pairs_)])
    return out


def test_log_ratios_and_top_k_by_hand(spark):
    rng = random.Random(21)
    say = lambda: " ".join(rng.choice(["stone", "Sand", "x9", "the", "THE", "a,", "end.", "naïve", "!!", "longer-than-sixteen-bytes"]) for _ in range(rng.randint(0, 40)))
    rows = [(k, say()) for k in range(200)] + [(200, None), (201, ""), (None, say()), (5, say()), (7, say())]
    labels = [(k, int(k % 3 > 0), 0) for k in range(0, 150, 2)] + [(None, 1, 0), (999, 1, 0)]
    found = quality.resampled(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    grams = by_hand([t for _, t in rows])
    good = {k for k, q, _ in labels if q and k is not None}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for (key, _), of in zip(rows, grams, strict=True):
        np.add.at(raw, of, 1)
        if key in good:
            np.add.at(target, of, 1)
    raw, target = [c + quality.SMOOTHING * c.mean() for c in (raw, target)]
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    want = Counter((key, round(float(ratio[of].sum()), 6) + 0.0) for (key, _), of in zip(rows, grams, strict=True))
    assert Counter((r["doc_id"], round(r["log_ratio"], 6) + 0.0) for r in found) == want
    known = [q for k, q, _ in labels if k is not None]
    share = sum(known) / len(known)
    k = math.ceil(min(1, share + 2 * (share * (1 - share) / len(known)) ** 0.5) * len(rows))
    least = sorted((r["perturbed"] for r in found), reverse=True)[k - 1]
    assert all(r["kept"] == (r["perturbed"] >= least) for r in found)


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet"), spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    result = quality.resampled(docs, fit).join(held, "doc_id").groupBy("quality", "kept").count().collect()
    count = {(r["quality"], r["kept"]): r["count"] for r in result}
    assert count.get((1, False), 0) <= 0.005 * count[1, True]
    assert count[0, False] >= 0.85 * (count[0, False] + count.get((0, True), 0))


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (7, 1, 0), (7, 1, 0), (10, 0, 0), (None, 1, 0), (99999, 1, 0)], "doc_id long, quality int, toxic int")
    result = quality.resampled(odd, labels)
    assert result.count() == odd.count() and result.where("log_ratio is null or isnan(log_ratio)").count() == 0
    assert quality.kept_rows(odd, labels).columns == odd.columns
    assert quality.kept_rows(odd, labels).count() == result.where("kept").count()
    assert quality.resampled(none, labels).count() == 0
    assert quality.resampled(odd, labels.limit(0)).where("kept").count() == odd.count()


@pytest.mark.parametrize("k", [1, 2, 499, 500, 999, 1000, 2000])
def test_kth_highest(spark, k):
    rng = random.Random(k)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e6), 5.0]) for _ in range(1000)]
    threshold = quality.kth_highest(spark.createDataFrame([(v,) for v in values], "v double"), "v", k)
    exact = sorted(values, reverse=True)[k - 1] if k < 1000 else float("-inf")
    assert sum(v >= threshold for v in values) == sum(v >= exact for v in values)
