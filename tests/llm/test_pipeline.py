from __future__ import annotations

import hashlib
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from quarrow.llm import mixing, pii, quality
from quarrow.llm.common import written

from ..conftest import DATA
from .test_pairs import linked

FOLDER = f"{DATA}/sf0.001"


def test_stages_and_run(spark, odd):
    import corpus_pipeline

    for start in (spark.read.parquet(f"{FOLDER}/documents.parquet"), odd.select("doc_id", "text", "lang", "source", "n_chars")):
        docs, names = start, start.columns
        sizes = []
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, FOLDER), "stage")
            sizes.append(docs.count())
            assert docs.columns == names or name == corpus_pipeline.STAGES[-1][0]
        assert sizes[0] >= sizes[1] == sizes[2] and sizes[3] == sizes[4] > 0
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_stages_on_empty_tables_and_clashing_names(spark, odd, none):
    import corpus_pipeline

    clashing = odd.limit(12).withColumns({"a.b": F.lit(1), "place": F.lit("x"), "perturbed": F.lit(2.5), "document": F.lit(None).cast("string"), "copies": F.lit(0), "held": F.lit(0)})
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, none, FOLDER)
        assert empty.count() == 0 and (empty.columns == none.columns or name == "byte_level_bpe")
        found = stage(spark, clashing, FOLDER)
        assert found.count() > 0 and (found.columns == clashing.columns or name == "byte_level_bpe")


def without(text):
    """A text with its spans replaced, character by character."""
    if not text:
        return text
    base, added = pii.find(text)
    out, at = [], 0
    for kind, a, b in sorted([*base, *added], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out.append(text[at:a] + f"<{kind}>")
        at = max(at, b)
    return "".join(out) + text[at:]


def test_run_by_hand(spark):
    import corpus_pipeline

    P, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    from quarrow.llm.bpe import tokens_of

    docs, labels = [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")]
    kept = {r["doc_id"] for r in quality.resampled(docs, labels).where("kept").collect()}  # held against counts by hand in another test
    rows = [r.asDict() for r in docs.collect() if r["doc_id"] in kept]
    least = {key for key, n, component in linked([(r["doc_id"], r["text"] or "") for r in rows], 5, Fraction(4, 5)) if not n or component == key}
    rows = [r | {"text": without(r["text"])} for r in rows if r["doc_id"] in least]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r["doc_id"], r["text"], r["source"]) for r in rows])
    copies = {key: taken // size for key, size, taken in duck.sql(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE_SQL}) WHERE size > 0").fetchall()}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens_of(P.path("byte_bpe_50k.tiktoken")))}, special_tokens={})
    want = Counter()
    for r in rows:
        if r["doc_id"] in copies:
            packed = b"".join(t.to_bytes(4, "little") for t in coder.encode_ordinary(r["text"]))
            want[r["doc_id"], len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] += copies[r["doc_id"]]
    found = corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(tuple(r) for r in found if r["n_tokens"]) == +want


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_executors_give_heap_back(spark):
    from quarrow.llm.common import heaps_given_back

    full = next(b for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Young" not in b.getName() and "Scavenge" not in b.getName() and "Copy" not in b.getName())
    before = full.getCollectionCount()
    heaps_given_back(spark, 0)
    assert full.getCollectionCount() == before
    heaps_given_back(spark, 1)  # tasks run in this JVM here
    assert full.getCollectionCount() > before
