"""The queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import alignment, collocations, decontam, exact_dedup, license_scan, mixing, phrase_dedup, quality, secret_scan, simhash, substring_dedup, toxicity, url_filter
from quire.llm.common import read


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))[0].select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.phrase_digest(read(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "n_strict", "n_soft", "verdict")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents")).select("doc_id", *exact_dedup.VERDICT)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "doc_start", "item_start", "words", "agree")


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_rows(read(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(read(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_classes(read(spark, sf_dir, "documents"))
    return marked.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


_ALL = (
    op1_mixing_sources, op2_suffix_array_dedup, op3_substring_dedup, op4_url_filters, op5_exact_dedup, op6_benchmark_decontamination, op7_license_scans, op8_quality_classifier, op9_secret_scans, op10_simhash_near_dedup,
    op11_toxicity, op12_phrase_collocations, op13_tokenizer_alignment,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE_SQL = {
    "op2_suffix_array_dedup": substring_dedup.ORACLE,
    "op3_substring_dedup": phrase_dedup.ORACLE,
    "op4_url_filters": url_filter.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op12_phrase_collocations": collocations.ORACLE,
}
