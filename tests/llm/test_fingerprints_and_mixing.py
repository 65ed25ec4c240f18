from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from quarrow.llm import fingerprints, mixing

from ..conftest import DATA
from .conftest import pairs


def paragraphs(text):
    return {p for p in re.split(r"\n+|(?<=[.!?])\x20+", text) if p}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_fingerprints(which, request):
    df = request.getfixturevalue(which)
    rows = sorted(pairs(df), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want, texts = Counter(), defaultdict(set)
    for k, (key, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        want[key, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(paragraphs(text), paragraphs(edited)), 9), round(likeness(paragraphs(text), paragraphs(other)), 9)] += 1
    found = fingerprints.fingerprints(df).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found) == want
    digests = {r["edited_sha256"]: r["edited_fingerprint"] for r in found}
    for r in found:
        texts[r["edited_sha256"]].add(r["edited_fingerprint"])
        assert digests[r["edited_sha256"]] == r["edited_fingerprint"]
    assert all(len(f) == 1 for f in texts.values())


def test_fingerprints_of_one_document(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    row = fingerprints.fingerprints(df).first()
    assert row["near_next"] == 1.0 and row["fingerprint"].count(";") >= 3


def test_fingerprints_are_native(docs):
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_mix_matches_sorting(spark):
    folder = f"{DATA}/sf0.01"
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = Counter(duck.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.ORACLE_SQL})").fetchall())
    assert Counter(tuple(r) for r in mixing.words_taken(spark.read.parquet(f"{folder}/documents.parquet")).collect()) == want


def filled(sizes: dict) -> dict:
    """Targets by resharing, as stated."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        over = [s for s in order if s not in capped and rest * weight[s] / free > 3 * sizes[s] + 1e-9]
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        capped |= set(over)


def test_mix_of_odd_rows(odd, none):
    rows = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in odd.collect()]
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    found = mixing.words_taken(odd).collect()
    assert len(found) == len(rows)
    targets = filled(sizes)
    assert {round(r["target"], 6) for r in found} == {round(t, 6) for t in targets.values()}
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    assert sorted(map(tuple, mixing.words_taken(odd).collect()), key=repr) == sorted(map(tuple, found), key=repr)
    assert mixing.words_taken(none).count() == 0 and mixing.mixed_rows(none).columns == none.columns


def test_mixed_rows_repeat(spark):
    rows = [(k, "w " * 10, "a" if k < 20 else "b") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = Counter(r["source"] for r in mixing.mixed_rows(df).collect())
    assert copies["a"] == 60 and copies["b"] == 340
