"""The registered training-data queries: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medley.llm import (bpe_transducer, hard_negatives, hmm_scores, iblt_fingerprint, licenses,
                        ngram_join, oracles, piece_lattice, quality_rules, secrets, sharding,
                        substring_dedup, template_decontam, token_alignment)
from medley.plans.given import table


def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return (ngram_join.join_components(table(spark, sf, "documents"))
            .select("doc_id", "n_shingles", "component_id", "class_id"))


def op2_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return hmm_scores.score(table(spark, sf, "documents"))


def op3_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return piece_lattice.encode(table(spark, sf, "documents"), n=3)


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign(table(spark, sf, "documents"))


def op5_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf, "documents"))


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf, "documents"))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return template_decontam.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return iblt_fingerprint.fingerprint(table(spark, sf, "documents"))


def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_transducer.token_counts(table(spark, sf, "documents"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.noisy_labels(table(spark, sf, "embeddings")))


def op12_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_report(table(spark, sf, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf, "documents"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_sharding": op4_sharding,
    "op5_secret_scans": op5_secret_scans,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_license_scans": op12_license_scans,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
ORACLES = {
    "op1_ngram_jaccard_join": oracles.NGRAM_JOIN,
    "op5_secret_scans": oracles.SECRET_SCANS,
    "op6_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op12_license_scans": oracles.license_scans(licenses.PHRASES, licenses.TEMPLATES, licenses.PERCENT),
}
