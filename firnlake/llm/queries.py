"""Queries over the synthetic tables, one for each operator: thin adapters from an operator to its result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .brown_lm import brown_scores
from .common import read_table
from .decontam import verdicts
from .kn_quality import quality
from .licenses import license_scan
from .mixing import mix
from .ngram_join import jaccard_components
from .pii import count_kind, find_pii, spans_text
from .quality_rules import quality_rules
from .simple8b import token_ids
from .toxicity import toxicity


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files source/lang/doc_id.txt."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("_")), F.lit(".txt")))
    docs = read_table(spark, sf_dir, "documents").withColumn("path", path)
    return license_scan(docs, keep=("doc_id",))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_verdict")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_pii(read_table(spark, sf_dir, "documents"))
    counts = [count_kind("base", k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return out.select("doc_id", *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))


def op6_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_scores(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.withColumn("item_ids", F.array_join(F.col("item_ids").cast("array<string>"), ","))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_ids(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), read_table(spark, sf_dir, "labels")).drop("text")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_times")).alias("taken"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_join, op2_pii, op3_licenses, op4_toxicity, op5_quality_rules, op6_brown_lm, op7_decontamination, op8_token_ids, op9_quality_classifier, op10_mixing)}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": oracle.NGRAM_JOIN, "op5_quality_rules": oracle.QUALITY_RULES, "op7_decontamination": oracle.DECONTAMINATION}
