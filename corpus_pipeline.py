"""A pipeline over documents: STAGES in their order, each written as Parquet and reread as the next one's input.

Trusted text trains the quality classifier, whose rejects go; of each group of near copies (five-word shingles, Jaccard
similarity 0.8 or more) one document stays; documents with benchmark passages go; sources are mixed to their weights, by
repeating and leaving out documents; the mixture's token ids are written in Simple-8b blocks and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firnlake.llm.common import materialize, read_table, shrink
from firnlake.llm.decontam import decontaminate
from firnlake.llm.kn_quality import keep_good
from firnlake.llm.mixing import repeat_documents
from firnlake.llm.ngram_join import one_of_each
from firnlake.llm.simple8b import token_ids


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shrink(spark)
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shrink(spark)
    return one_of_each(docs, k=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeat_documents(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shrink(spark)
    return token_ids(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources", mixing_stage),
    ("token ids", tokens_stage),
]

#: SQL can express none of the classifier, the similarity join, the tokenizer and the budget fitting.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
