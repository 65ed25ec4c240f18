"""Token counts without token ids.

The model cuts a text into pre-tokens and every pre-token into pieces on its
own, so a text has as many tokens as the sum, over its distinct pre-tokens, of
frequency times number of pieces. Pieces are counted once for each distinct
pre-token of the corpus (:mod:`.pieces`); those counts are joined to the
documents' pre-token frequencies and added up. Ids are never made into a column.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text
from .pieces import Answers, by_pieces, parts_of

#: Characters on which Python's normalisation, lower-casing and classes agree
#: with the tokenizer's own at any Unicode version (a test compares them all).
PLAIN = r"[\x00-ɏ‐-‧ぁ-ゖァ-ヺ一-龥]*"


class Counts:
    """Piece counts of a ``.json`` tokenizer, by pre-token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.whole = Tokenizer.from_file(path)
        steps = model["pre_tokenizer"]["pretokenizers"]
        self.pieces = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.plain = regex.compile(PLAIN).fullmatch
        special = [t["content"] for t in model["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        alone = model | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps[1:]}}
        self.alone = Tokenizer.from_str(json.dumps(alone))
    def pre_tokens(self, text: str) -> list[str]:
        """Normalised pre-tokens of a text without special strings."""
        if self.plain(text):
            return self.pieces(unicodedata.normalize("NFC", text).lower())
        text = self.whole.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Pre-tokens and the number of special strings, which count one each, part by part."""
        special = len(self.special.findall(text)) if self.special else 0
        yield [], special
        for part in self.special.split(text) if special else [text]:
            for some in parts_of(part, _space):
                yield self.pre_tokens(some), 0

    def count(self, pieces: list[str]) -> list[int]:
        """How many pieces each pre-token has."""
        return [len(e) for e in self.alone.encode_batch(pieces, add_special_tokens=False)]

    def block(self, texts: list[str]) -> list[int]:
        """Each text's number of tokens, without the exchange: for a few texts."""
        found = [[piece for part, _ in self.cut(text) for piece in part] for text in texts]
        distinct = list(set().union(*found))
        counts = dict(zip(distinct, self.count(distinct), strict=True))
        return [sum(map(counts.__getitem__, pieces)) + sum(n for _, n in self.cut(text)) for text, pieces in zip(texts, found, strict=True)]


def _space(text: str, at: int) -> int:
    """Behind the first space from ``at`` on: no pre-token holds white space."""
    return text.find(" ", at) + 1 or len(text)


@functools.lru_cache(maxsize=2)
def counts_of(path: str) -> Counts:
    """A worker reads a tokenizer once."""
    return Counts(path)


def token_counts(df: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` of every whole text.

    ``path`` is a ``.json`` tokenizer on every executor. Null or empty text: no
    bytes, no tokens, not over the limit. Special strings inside a text count as
    the special tokens they name, as by that library's default. Very long texts
    are cut in parts between pre-tokens. Repeated rows stay repeated, an empty
    table gives an empty result; extra columns are dropped.
    """

    def cutter():
        return counts_of(path).cut

    def worker():
        count = counts_of(path).count
        return lambda pieces: [n.to_bytes(4, "little") for n in count(pieces)]

    def fold(columns: dict[str, pa.Array], special: np.ndarray, counts: np.ndarray, numbers: np.ndarray, answers: Answers) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(counts)), counts)
        held, times = np.unique(owner << 32 | numbers, return_counts=True)  # a document's distinct pre-tokens, and their frequencies
        each, _ = answers.joined(held & (1 << 32) - 1, 4)
        totals = np.bincount(held >> 32, each * times, minlength=len(counts)).astype(np.int64) + special
        return pa.record_batch([columns["id"], columns["n_bytes"], pa.array(totals)], names=[id_col, "n_bytes", "n_tokens"])

    data = id_and_text(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = by_pieces(data, cutter, worker, fold, f"`{id_col}` {data.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
