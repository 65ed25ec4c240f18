"""From raw documents to token ids: classify, drop near copies, redact, mix, encode.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.

All stages: columns that they do not use pass, whatever their names (all but the
last); an empty table gives an empty one; nothing fails on nulls in any column or
on texts that are empty or very long.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrow.llm import bpe, jaccard_join, mixing, pii, quality
from quarrow.llm.common import documents, written


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go.

    Null and empty texts score 0, as does every text where no label says good.
    Rows with one id and text share their fate; of tied scores at the threshold all stay.
    """
    return quality.kept_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8).

    It is the one with the smallest id, any one of repeated rows. Null and empty
    texts have no words, are nobody's copy and stay.
    """
    return jaccard_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kinds.

    No row goes; null texts stay null, empty ones empty; ``n_chars`` is made anew
    (null for null texts). Overlapping spans are replaced together.
    """
    return _measured(pii.without_personal_data(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null sources are one source, the last. Null and empty texts have no words and
    are taken like others of their source; rows with one id share their fate.
    """
    return mixing.mixed_rows(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids, with digests of them and of what they decode to.

    Null and empty texts have no ids; repeated rows stay repeated. Columns:
    doc_id, ids, n_tokens, ids_sha256, decoded_sha256.
    """
    return bpe.tokenised(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("byte_level_bpe", byte_level_bpe),
]

#: Models, components and pre-token merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
