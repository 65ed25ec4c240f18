"""Quality classification by importance resampling.

Two generative models over hashed n-grams are counted: one of target texts (a
bounded sample of rows labelled good), one of all raw texts. A document's
importance weight is the ratio of its probabilities under both. Gumbel noise
from a hash of the id is added to the logarithm, and the k highest are kept:
sampling without replacement by importance. k is the share of good labels.

n-grams are of words and of word shapes (letter case, punctuation, length,
repetition of the word before), so that texts of unseen words are judged too.
The k-th highest score comes from nested histograms; nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, dropped, quoted, written
from .words import SEGMENT, Words, mixed, segments, words_of

#: Buckets of the hashed n-grams; the size of both models.
BUCKETS = 1 << 14
#: At most so many labelled rows make the target model (those of the lowest hashes).
TARGET_ROWS = 20_000
#: Pseudo-counts for every bucket of either model, as a share of its mean count.
SMOOTHING = 0.01
#: Bins of a histogram, and histograms at most, in the search for the k-th score.
BINS, LEVELS = 4096, 5

_CLASS = np.zeros(256, dtype=np.int64)
for _k, _of in enumerate((range(97, 123), range(65, 91), range(48, 58), range(128, 256))):
    _CLASS[list(_of)] = _k + 1


def _shapes(words: Words) -> np.ndarray:
    """A small number for each word's form, and whether it repeats the word before."""
    kinds = _CLASS[words.data]
    sums = [np.concatenate([[0], np.cumsum(kinds == k)]) for k in range(5)]
    punct, lower, upper, digit, _ = [s[words.ends] - s[words.starts] for s in sums]
    length = np.searchsorted([2, 4, 8, 16], words.ends - words.starts)
    last = np.where(kinds[words.ends - 1] == 0, words.data[words.ends - 1] if len(words.ends) else 0, 0)
    again = np.zeros(len(length), dtype=np.int64)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    again[words.first[:-1][np.diff(words.first) > 0]] = 0  # whatever text lies before it in the block
    shape = np.minimum(punct, 3)
    for part, width in ((lower > 0, 2), (np.minimum(upper, 2), 3), (digit > 0, 2), (length, 5), (last, 256), (again, 2)):
        shape = shape * width + part
    return shape


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(buckets, owners)`` of all n-grams: words, shapes, and pairs of shapes.

    They come a segment at a time. Of a text cut in segments, the last two words
    of one go into the next, where only what they form with new ones counts.
    """
    before, carried = -1, b""
    for index, part in segments(texts):
        skip = 0
        if index == before and len(part) == 1:
            skip = len(carried.split(b" ")) - 1
            part = pa.array([carried + part[0].as_py()], pa.large_binary())
        words = words_of(part)
        owner = np.repeat(np.arange(index, index + len(part)), np.diff(words.first))
        shape = mixed(_shapes(words).astype(np.uint64) + np.uint64(1))
        inner = np.flatnonzero(owner[1:] == owner[:-1])[max(0, skip - 1) :]
        pair = mixed(shape[inner] * np.uint64(31) + shape[inner + 1])
        every = np.concatenate([words.hashes[skip:], shape[skip:], pair])
        yield (every % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([owner[skip:], owner[skip:], owner[inner]])
        before = index + len(part) - 1
        carried = b"".join([words.data[a:z].tobytes() + b" " for a, z in zip(words.starts[-2:], words.ends[-2:], strict=True)])


def models(df: DataFrame, target: Column | str, text_col: str = "text") -> DataFrame:
    """``(bucket, target, raw)``: n-gram counts of rows under ``target`` and of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for block in blocks(batches, limit=SEGMENT):
            target = block.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for bucket, owner in grams(block.column(1)):
                raw += np.bincount(bucket, minlength=BUCKETS)
                good += np.bincount(bucket[target[owner]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(good[seen]), pa.array(raw[seen])], names=["bucket", "target", "raw"])

    rows = df.select(F.coalesce(target, F.lit(False)).alias("target"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = rows.mapInArrow(run, "bucket int, target long, raw long")
    return counted.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Logarithm of target to raw probability by bucket; the fixed-size model."""
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():  # BUCKETS rows at most
        target[row["bucket"]], raw[row["bucket"]] = row["target"], row["raw"]
    if not target.sum():
        return np.zeros(BUCKETS)
    both = [c + SMOOTHING * c.mean() for c in (target, raw)]
    return np.log(both[0] / both[0].sum()) - np.log(both[1] / both[1].sum())


def _scorer(ratios: np.ndarray):
    """A column function: the log importance weight of texts."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = []
        for block in blocks([pa.record_batch([texts], names=["text"])], column=0, limit=SEGMENT):
            parts.append(np.zeros(block.num_rows))
            for bucket, owner in grams(block.column(0)):
                parts[-1] += np.bincount(owner, ratios[bucket], minlength=block.num_rows)
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def _noise(identity: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the id."""
    digest = F.xxhash64(F.coalesce(identity.cast("string"), F.lit("")), F.lit(seed))
    uniform = (F.shiftrightunsigned(digest, 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_highest(scores: DataFrame, column: str, k: int) -> float:
    """A threshold that ``k`` values reach, by nested histograms of ``BINS`` bins.

    Where values tie (or come closer than the last histogram tells apart), a few
    more may reach it. ``k`` of all or more gives minus infinity.
    """
    value = F.col(column)
    low, high, total = scores.agg(F.min(value), F.max(value), F.count(value)).first()
    if not total or k >= total:
        return float("-inf")
    if k <= 0:
        return float("inf")
    for _ in range(LEVELS):
        width = (high - low) / BINS
        if width <= 0:
            break
        place = F.least(F.floor((value - low) / width), F.lit(BINS - 1)).cast("int")
        inside = scores.where((value >= low) & (value <= high)).groupBy(place.alias("bin")).agg(F.count("*").alias("held"), F.min(value).alias("least"), F.max(value).alias("most"))
        bins = sorted(inside.collect(), key=lambda r: -r["bin"])  # BINS rows at most
        for row in bins:
            if row["held"] >= k:
                break
            k -= row["held"]
        low, high = row["least"], row["most"]
        if row["held"] == k:
            break
    return low


class Classifier:
    """Fitted on all of ``df`` and a bounded sample of ``labels``."""

    def __init__(self, df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good: str = "quality = 1", seed: int = 7):
        self.id_col, self.text_col, self.seed = id_col, text_col, seed
        share = labels.where(F.col(quoted(id_col)).isNotNull()).agg(F.avg(F.expr(good).cast("double")), F.count("*")).first()
        self.share = 1.0 if share[0] is None else min(1.0, share[0] + 2 * (share[0] * (1 - share[0]) / share[1]) ** 0.5)
        picked = labels.where(F.expr(good) & F.col(quoted(id_col)).isNotNull()).select(F.col(quoted(id_col)).alias("id")).distinct()
        picked = picked.orderBy(F.xxhash64("id"), "id").limit(TARGET_ROWS).withColumn("good", F.lit(True))
        rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id", "left")  # TARGET_ROWS ids at most
        self.ratios = log_ratios(models(rows, F.col("good")))

    def scored(self, df: DataFrame) -> DataFrame:
        """``df`` with ``log_ratio`` and ``perturbed``, its noisy copy."""
        score = _scorer(self.ratios)(F.coalesce(F.col(self.text_col), F.lit("")))
        return df.withColumn("log_ratio", score).withColumn("perturbed", F.col("log_ratio") + _noise(F.col(self.id_col), self.seed))


def resampled(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, log_ratio, perturbed, kept)`` of every row.

    ``kept``: among the k highest perturbed scores, k being the share of good
    labels (two standard errors up) of all rows. Null and empty texts score 0, very
    long ones are read a segment at a time; an empty table gives an empty result.
    Without good labels every row scores 0, and noise alone decides; without
    labels all rows are kept. Rows with one id and text share their fate.
    """
    fitted = Classifier(df, labels, id_col, text_col)
    scores = written(fitted.scored(df.select(id_col, text_col)).select(id_col, "log_ratio", "perturbed"), "quality-scores")
    threshold = kth_highest(scores, "perturbed", int(np.ceil(fitted.share * scores.count())))
    return scores.withColumn("kept", F.col("perturbed") >= threshold)


def kept_rows(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that :func:`resampled` keeps, with all their columns."""
    fitted = Classifier(df, labels, id_col, text_col)
    scores = written(fitted.scored(df.select(id_col, text_col)).select("perturbed"), "quality-scores")
    threshold = kth_highest(scores, "perturbed", int(np.ceil(fitted.share * scores.count())))
    dropped(scores)
    row = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"), F.col(id_col), F.col(text_col))
    return fitted.scored(row.select("row", id_col, text_col)).where(F.col("perturbed") >= threshold).select("row.*")
