from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

os.environ["TOKENIZERS_PARALLELISM"] = "false"
tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from quarrow.llm import bpe, token_counts  # noqa: E402

from .conftest import pairs  # noqa: E402

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: k for k, t in enumerate(bpe.tokens_of(RANKS))}, special_tokens={})


def ids(packed: bytes) -> list[int]:
    return [int.from_bytes(packed[k : k + 4], "little") for k in range(0, len(packed), 4)]


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_round_trip(which, reference, request):
    df = request.getfixturevalue(which)
    found = Counter(tuple(r) for r in bpe.round_trip(df, RANKS, P.PATTERN).collect())
    want = Counter()
    for key, text in pairs(df):
        tokens = reference.encode_ordinary(text)
        packed = b"".join(t.to_bytes(4, "little") for t in tokens)
        want[key, len(tokens), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert found == want


@given(st.lists(st.text(alphabet="abeht \n'’sdé日😀1_-!\x1c\x85​", max_size=60), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_any_text_is_encoded_alike(texts):
    encoder = bpe.encoder_of(RANKS, P.PATTERN)
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: k for k, t in enumerate(bpe.tokens_of(RANKS))}, special_tokens={})
    assert [ids(p) for p in encoder.block(texts)] == [other.encode_ordinary(t) for t in texts]


def test_both_replays_agree_on_words_of_any_length(reference):
    ranks = bpe.ranks_of(RANKS)
    rng = random.Random(3)
    words = ["".join(rng.choice("aabcdetho .") for _ in range(n)).encode() for n in (1, 2, 3, 17, 255, 256, 400)] + [b"a" * 5000, b"ab" * 3000]
    assert bpe.replay(words[:-2], ranks) == bpe.replay_long(words[:-2], ranks)
    assert [ids(p) for p in bpe.replay_long(words, ranks)] == [reference._encode_single_piece(w) for w in words]
    assert bpe.replay([], ranks) == [] == bpe.replay_long([], ranks)


def test_decoding_unknown_ids_fails(spark):
    df = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x7f"))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="IndexError"):
        bpe.decode(df, RANKS).collect()


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def lengths(tokenizer, texts):
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_token_counts(which, whole, request):
    df = request.getfixturevalue(which)
    rows = pairs(df)
    want = Counter((k, len(t.encode()), n, n > 2048) for (k, t), n in zip(rows, lengths(whole, [t for _, t in rows]), strict=True))
    assert Counter(tuple(r) for r in token_counts.token_counts(df, WORDS).collect()) == want


def test_every_character_counts_alike(whole):
    counts = token_counts.counts_of(WORDS)
    step = 40_000
    marks = [f"a{c}!{c}1{c}{c} {c}" for c in map(chr, (*range(0xD800), *range(0xE000, 0x30000)))]
    for k in range(0, len(marks), step):
        assert counts.block(marks[k : k + step]) == lengths(whole, marks[k : k + step])


def test_special_strings_count_once(whole):
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "a", "É", "é", " ", "ΑΣ", "'s", "1", "İ"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(3000)]
    assert token_counts.counts_of(WORDS).block(texts) == lengths(whole, texts)
