"""A corpus prepared for training: language, near duplicates, personal data, mix of sources, tokens."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.llm import bpe, langid, minhash, mixing, pii
from touchpath.llm.common import ship, unused, written

# documents whose language is less likely than this go, as do those without a letter
LEAST_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with their columns, also those named as the network's are.

    Null and empty texts and texts without a letter go; repeated rows are judged alike.
    """
    ship(spark)
    own = {name: unused(docs, f"_{name}") for name in docs.columns if name.lower() in ("lang_pred", "score", "held_out")}
    judged = langid.identify(docs.withColumnsRenamed(own))
    known = judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return known.select(*[F.col(f"`{own.get(name, name)}`").alias(name) for name in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return minhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; n_chars follows the text."""
    replaced = pii.replace(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        replaced = replaced.withColumn("n_chars", F.length("text").cast(kind))
    return replaced.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target parts: each document as often as it is taken."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (little-endian unsigned 32-bit integers)."""
    ship(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

# a trained network and surrogates cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
