"""The corpus operators' queries over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprints, gif_media, jaccard_join, mixing, pii, quality, secrets, suffix_dedup, token_counts
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]

#: Where the public vocabulary files lie; a parameter of every tokenizing operator.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), BYTE_BPE, public_tokenizers.PATTERN)


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(documents(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_repeats(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), WORD_BPE)


def op7_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif_media.stored_texts(documents(spark, sf_dir))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir)).drop("redacted")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.clusters(documents(spark, sf_dir))


_QUERIES = (
    op1_byte_level_bpe,
    op2_document_fingerprints,
    op3_source_mixing,
    op4_secret_scan,
    op5_suffix_array_dedup,
    op6_token_counts,
    op7_gif_media,
    op8_pii,
    op9_quality_classifier,
    op10_ngram_jaccard_join,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_source_mixing": mixing.ORACLE_SQL, "op5_suffix_array_dedup": suffix_dedup.ORACLE_SQL, "op10_ngram_jaccard_join": jaccard_join.ORACLE_SQL}
