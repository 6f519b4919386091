"""Five stages from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafworks.llm import bpe, line_dedup, ngram_join, packing, quality_rules, substring_dedup
from sheafworks.session import scratch_path


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, alone or with their host, go."""
    return quality_rules.stage(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three or more documents stay in the last one only."""
    return line_dedup.stage(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return ngram_join.one_of_each(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that start anywhere else go."""
    return substring_dedup.stage(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All tokens in sequences of 1024."""
    return packing.pack_documents(docs, bpe.vocabulary_path())


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("substring_dedup", substring_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Tokenization cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
