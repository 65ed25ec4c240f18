from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from quarrow.llm import jaccard_join, suffix_dedup, words
from quarrow.llm.common import id_and_text

from ..conftest import DATA
from .conftest import pairs


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def linked(rows, width, threshold):
    """Components by comparing every pair that shares a shingle."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets.append({tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    places = defaultdict(list)
    for k, s in enumerate(sets):
        shared = Counter(j for x in s for j in places[x])
        for x in s:
            places[x].append(k)
        for j, n in shared.items():
            if n * threshold.denominator >= threshold.numerator * (len(s) + len(sets[j]) - n):
                root[find(k)] = find(j)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[find(k)] = min(key, least.get(find(k), key))
    return Counter((key, len(sets[k]), least.get(find(k), key)) for k, (key, _) in enumerate(rows))


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 30)) for _ in range(120)) for _ in range(4)]
    rows = []
    for k in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(["x", "y", "zz"]) + str(rng.randint(0, 9))
        rows.append((k, " ".join(words)))
    rows += [(k, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))) for k in range(150, 260)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("which, width, threshold", [("copies", 3, Fraction(9, 10)), ("odd", 3, Fraction(9, 10)), ("none", 3, Fraction(9, 10)), ("docs", 3, Fraction(9, 10))])
def test_components(which, width, threshold, request):
    df = request.getfixturevalue(which)
    found = Counter(tuple(r) for r in jaccard_join.clusters(df, width, threshold).collect())
    assert found == linked(pairs(df), width, threshold)


def test_components_at_the_pipelines_width(copies):
    found = Counter(tuple(r) for r in jaccard_join.clusters(copies, 5, Fraction(4, 5)).collect())
    assert found == linked(pairs(copies), 5, Fraction(4, 5))


def test_star_rounds_and_the_rest_give_the_same(copies, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS_LEFT", 0)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 2)
    assert Counter(tuple(r) for r in jaccard_join.clusters(copies).collect()) == linked(pairs(copies), 3, Fraction(9, 10))


def test_one_of_each_group_stays(odd, copies):
    for df in (odd, copies):
        kept = jaccard_join.one_of_each(df)
        groups = {c for _, n, c in linked(pairs(df), 5, Fraction(4, 5)) if n and c is not None}
        assert kept.columns == df.columns
        words = [r["doc_id"] for r in kept.collect() if (r["text"] or "").split()]
        assert len(words) == len(set(words)) and {w for w in words if w is not None} == groups


def test_sets_that_share_enough_are_found(spark, copies):
    rng = random.Random(6)
    rows = pairs(copies) + [(1000 + k, " ".join(rng.choice("abc") + str(rng.randint(0, 400)) for _ in range(rng.randint(3, 40)))) for k in range(300)]
    rows += [(2000, rows[300][1]), (2001, None), (2002, "")]
    like = jaccard_join.Similarity(Fraction(4, 5), 2)
    data = id_and_text(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    found = {(r["f1"], r["f2"]) for r in jaccard_join._candidates(data, like).collect()}
    sets, texts = {}, Counter()
    for _, text in rows:
        h, first = words.distinct(*words.shingles(*words.word_hashes(pa.array([text])), 2))
        if len(h):
            f1, f2 = jaccard_join._hashes(h, first)
            sets[int(f1[0]), int(f2[0])] = h.tolist()
            texts[int(f1[0]), int(f2[0])] += 1
    held = Counter(x for h in sets.values() for x in h)
    want = {k for k, h in sets.items() if sum(held[x] > 1 for x in h) >= like.least_overlap(np.array([len(h)]))[0]}
    assert want <= found <= want | {k for k, n in texts.items() if n > 1} and want and len(found) < len(sets)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(500, 501)], "a long, b long")
    found = {r["node"]: r["root"] for r in jaccard_join.components(edges).collect()}
    assert found == {**dict.fromkeys(range(101), 0), 500: 500, 501: 500}


def without_repeats(rows, length):
    count = Counter(data[k : k + length] for data in (t.encode() for _, t in rows) for k in range(len(data) - length + 1))
    out = Counter()
    for key, text in rows:
        data = text.encode()
        gone, reach = bytearray(len(data)), 0
        for k in range(len(data) - length + 1):
            if count[data[k : k + length]] > 1:
                gone[max(k, reach) : k + length] = b"\1" * (k + length - max(k, reach))
                reach = k + length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[key, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def passages(spark):
    rng = random.Random(8)
    said = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    shared = [said(rng.randint(30, 90)) for _ in range(10)]
    rows = []
    for k in range(120):
        text = ""
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(shared)
            cut = rng.random()
            part = part[rng.randint(0, 60) :] if cut < 0.3 else part[: len(part) - rng.randint(0, 60)] if cut < 0.5 else part[:40] + "#" + part[41:] if cut < 0.6 else part
            text += said(rng.randint(0, 20)) + part
        rows.append((k, text))
    rows += [(500, "a" * 1000), (501, "ab" * 300), (503, "x" * 199), (504, "x" * 200), (505, "y" * 200), (506, "y" * 200), (507, "Orre " * 100)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("which", ["passages", "odd", "none", "docs"])
def test_repeated_strings_go(which, request):
    df = request.getfixturevalue(which)
    assert Counter(tuple(r) for r in suffix_dedup.removed_repeats(df).collect()) == without_repeats(pairs(df), 200)


def test_long_texts_in_segments(passages, spark):
    rng = random.Random(31)
    rows = [r for r in pairs(passages) if r[0] < 40 or r[0] >= 500]
    filler = "".join(rng.choices("abcdefgh ", k=700_000))
    long = filler[:262_100] + rows[3][1] + rows[7][1] + filler[262_100:600_000] + filler[1000:1500] + filler[600_000:]
    rows += [(900, long), (901, filler[524_000:524_700] + "#" + filler[261_900:262_300])]
    assert len(long) > 2 * suffix_dedup.SEGMENT
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in suffix_dedup.removed_repeats(df).collect()) == without_repeats(rows, 200)


@pytest.mark.parametrize("operator", [suffix_dedup, jaccard_join])
def test_sql_twins(operator, docs):
    import duckdb

    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.001/documents.parquet'")
    found = suffix_dedup.removed_repeats(docs) if operator is suffix_dedup else jaccard_join.clusters(docs)
    assert Counter(tuple(r) for r in found.collect()) == Counter(connection.sql(operator.ORACLE_SQL).fetchall())


def test_other_lengths(passages, spark):
    df = passages.limit(60)
    rows = pairs(df)
    fixed = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in suffix_dedup.deduplicated(fixed, 75).collect())
    assert found == without_repeats(rows, 75)
    with pytest.raises(ValueError):
        suffix_dedup.deduplicated(fixed, 64)
