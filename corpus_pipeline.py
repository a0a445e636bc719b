"""From raw documents to token ids: classify, deduplicate, decontaminate, remove
secrets, encode. Each stage works on everything the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medley.llm import (ngram_join, piece_lattice, quality_rules, secrets, template_decontam)
from medley.plans.given import table
from medley.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of least id stays."""
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return template_decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the scores of the best segmentations and a decoding check."""
    return piece_lattice.encode(docs, n=3)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

# Training a model and searching a lattice are beyond SQL; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.split()[0]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
