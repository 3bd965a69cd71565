"""Corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; run() writes each result as Parquet
to the shared folder and reads it again as the next stage's documents.

Defined cases: documents with null or empty texts go through all stages and end as the end id alone, unless the
classifier rejects them; a table without rows gives no pieces; columns beside those of documents are dropped at the
first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import decontaminate, line_dedup, ngram_join, packing, quality
from tallyfold.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs.select(*COLUMNS), labels)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat, or nearly repeat, an earlier line go; the documents stay."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of similar documents the one with the smallest id stays.

    The contract of this stage's query sets 3-word shingles and 0.9; as a stage, near duplicates are those of five-word
    shingles at 0.8.
    """
    return ngram_join.representatives(docs, n=5, percent=80).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in windows of 4096 tokens, with their ids."""
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack_windows),
]

#: A learned classifier and a tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` through all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
