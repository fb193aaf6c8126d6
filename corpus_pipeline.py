"""From raw documents to a deduplicated, decontaminated and encoded corpus.

Each stage takes (spark, docs, sf_dir) and returns all rows it keeps; `run` writes every
stage's result as Parquet in the shared folder and reads it again, so a lost executor never
reaches back beyond one stage. Null ids and empty tables pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import byte_bpe, decontaminate, jaccard_join, line_dedup, quality_classifier
from wattloom.session import work_path

#: SQL cannot train the classifier; the stages are tested against brute force.
ORACLE_SQL = None

QUALITY_CUT = 0.3
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
    return scored.where(F.col("_score") >= QUALITY_CUT).select(*docs.columns)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_spans(docs, items).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN,
                                    byte_bpe.RUNS)
    return ids.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_shared_lines),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
