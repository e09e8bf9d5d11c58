"""A corpus from documents to a mix: quality, exact and near copies, benchmark passages, source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import read, stored
from quire.llm.decontam import decontaminate
from quire.llm.exact_dedup import exact_dedup
from quire.llm.mixing import mix
from quire.llm.quality import quality_filter
from quire.llm.simhash import near_dedup


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labels, does not reject.

    Null, empty and very long texts are scored whole by their features; repeated rows and null ids are rows like others; an
    empty table stays empty; further columns pass, whatever their names.
    """
    return quality_filter(docs, read(spark, sf_dir, "labels")).select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id.

    Null and empty texts are equal to each other, so one of them stays; a null id stays only if its text has no other; very long texts are
    compared whole; an empty table stays empty; further columns pass.
    """
    return exact_dedup(docs).where("kept").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (a similarity of 0.8 or more of five-word shingles, also over other documents), the document with the smallest id.

    Null and blank texts are one group; repeated rows of the smallest id all stay, as do rows without an id; very long texts are
    compared whole; an empty table stays empty; further columns pass.
    """
    return near_dedup(docs).select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item.

    Null and blank texts hold none and stay; very long ones are searched whole; repeated rows stay or go together; an empty table stays
    empty; further columns pass.
    """
    return decontaminate(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, repeats counted; a document that it does not take has 0.

    Null and blank texts have no words and give none; a null source is a source; repeated rows and null ids are documents of their own;
    an empty table gives an empty result. The result has its own columns.
    """
    return mix(docs)[0].withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("near-duplicate dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("source mixing", mix_sources),
]

#: SQL cannot express the classifier, the fingerprints or the schedule; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. What a stage keeps is stored before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else stored(docs), sf_dir)
    return docs
