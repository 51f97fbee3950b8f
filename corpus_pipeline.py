"""The stages from raw documents to token ids, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeat.llm import bpe, langid, mixing, neardup, secrets
from tallybeat.llm.text import whole
from tallybeat.sources.tables import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know.

    Rejected are those without a letter, those that no language leads clearly, and those
    that even the best model codes in more bits than random bytes have. ``lang`` stays as it
    was given. Null and empty texts go; null ids and repeated rows are judged by their text;
    columns may have any name; an empty table stays empty.
    """
    whole_rows = docs.select(F.struct("*").alias("given"), "doc_id", "text")
    found = langid.identify(whole_rows, langid.fit(docs), keep=True)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= langid.LEAST_SCORE)
    return found.filter(known & (F.col("bits_per_byte") <= langid.MOST_BITS)).select("given.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word shingles similar at 0.8.

    Documents without a word stay, each by itself; of a group the smallest id stays, null
    last; of repeated rows one; columns may have any name; an empty table stays empty.
    """
    return neardup.deduplicated(docs)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in their text replaced by a mark; n_chars follows.

    A null text stays null and has 0 characters; repeated rows stay; columns may have any name.
    """
    clean = secrets.cleaned(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length(whole(F.col("text"))).cast(docs.schema["n_chars"].dataType))
    return clean


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    A null source is a source; documents without a word are not taken; repeated rows share what
    is taken of them; columns may have any name; an empty table stays empty.
    """
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of the bytes they decode to.

    A null text has no token; every row, repeated or without an id, has a row of its own.
    """
    ranks = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(docs, ranks, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", no_secrets),
    ("mixture", mixture),
    ("token_ids", token_ids),
]
#: The models of the stages are not SQL; tests hold near duplicates, mixture and token ids against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of ``documents`` after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
