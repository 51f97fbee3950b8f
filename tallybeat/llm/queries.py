"""The operators applied to the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeat.llm import bpe, forest, langid, merkle, mixing, neardup, pii, quality, rules, secrets, substrings
from tallybeat.llm import urls, whitening
from tallybeat.llm.text import written

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def digest(spans: Column) -> Column:
    return F.sha2(written(spans), 256)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of all sources by weights 5, 2, 1 takes of each document."""
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op2_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of word pairs are similar at 0.8."""
    return neardup.groups(documents(spark, folder), neardup.Settings(words=2)).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return secrets.scan(documents(spark, folder)).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        digest(F.col("base")).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    return pii.scan(documents(spark, folder)).select(
        "doc_id",
        *[F.col(kind).alias(f"n_{kind}") for kind in pii.PATTERNS],
        digest(F.col("base")).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality and toxicity of every document, and whether it is kept."""
    return quality.judge(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op6_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words of windows of 20 that were seen earlier."""
    return substrings.removed(documents(spark, folder)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = documents(spark, folder)
    return langid.identify(docs, langid.fit(docs))


def op8_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return forest.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20)


def op9_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Line rules and the verdict on every document."""
    return rules.rule_report(documents(spark, folder)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "words_left",
        "base_failed",
        "kept",
    )


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, as digests, and the bytes they decode to."""
    ranks = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(documents(spark, folder), ranks)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on its first 16 whitened components, fitted on the distinct grid points."""
    whitened = whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"), 16)
    return whitening.by_component(whitened)


def op12_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The rule and the verdict for every page."""
    judged = urls.judge(spark.read.parquet(f"{folder}/pages.parquet"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the check of a copy with line breaks removed."""
    return merkle.audit(documents(spark, folder)).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("left"), F.col("right")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_neardup,
        op3_secrets,
        op4_pii,
        op5_quality,
        op6_substrings,
        op7_langid,
        op8_forest,
        op9_rules,
        op10_bpe,
        op11_whitening,
        op12_urls,
        op13_manifest,
    )
}
