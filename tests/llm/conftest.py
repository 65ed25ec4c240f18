from __future__ import annotations

import random

import pytest

from ..conftest import DATA

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, `size` int, `id` string, `ids` binary, `key` string, `component_id` string"


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows; more columns with names that operators use."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    base = " ".join(word() for _ in range(150))
    texts = [None, "", " \n\t ", "a", "A b", "Hello,  World's 42nd\r\n\x85\xa0don't STOP!!", "naïve 日本語 😀😀 ÉCOLE", base, base, base + " end", "x" * 3000, "ab " * 900, "one. two. three.\nfour"]
    texts += [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(25)]
    edited = base.split()
    for k in range(3):
        edited[10 + 40 * k] = "changed"
        texts.append(" ".join(edited))
    texts.append(" ".join(word() for _ in range(20_000)))
    texts.append('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" die.55@mail4.example.com 97.51.17.173 +1 (017) 555-7713 4111 1111 1111 1111')
    rows = [(k, t, rng.choice(["en", None]), rng.choice(["s1", "s2", None]), None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[7], rows[7], rows[12], (None, base, None, None, None), (None, None, None, None, None), (-5, "minus five", "en", "s1", 10)]
    return [(*r, "clash", 1, "clash", b"clash", None, "clash") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")


def pairs(df) -> list[tuple[int | None, str]]:
    """Ids and texts, null texts as empty ones."""
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
