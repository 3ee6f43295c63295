"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import html_text, quality, secrets, toxicity
from .decontaminate import find_items
from .exact_dedup import exact_duplicates
from .frames import table
from .jaccard_join import jaccard_components
from .line_dedup import line_summary
from .mixing import mix
from .oracle import ORACLE
from .spelling import spelling_variants
from .suffix_dedup import remove_repeats
from .vector_codes import vector_codes
from .winnow import edited_fingerprints


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_summary(table(spark, sf_dir, "documents"), equal_chars=1)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_html_extraction": op3_html_extraction,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_secret_scans": op5_secret_scans,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_line_dedup": op8_line_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_vector_codes": op12_vector_codes,
    "op13_exact_dedup": op13_exact_dedup,
}

__all__ = ["ORACLE", "QUERIES"]
