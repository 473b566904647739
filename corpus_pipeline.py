"""Corpus pipeline: stages from ``wayfarer.llm``, each written as Parquet and read again by the next.

Language identification drops documents without letters or in no learnt
language, the quality classifier drops what it scores below its threshold, the n-gram join
keeps one document of each near-duplicate group, mixing draws the sources to
their target weights, and packing lays the mix out in windows. Every stage but
the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfarer.llm.common import stored
from wayfarer.llm.langid import fit_language, keep_language
from wayfarer.llm.mixing import repeated
from wayfarer.llm.ngram_join import one_of_each_group
from wayfarer.llm.packing import packed
from wayfarer.llm.quality import fit_quality, keep_quality


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel classifier finds in a learnt language."""
    return keep_language(docs, fit_language(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_quality(docs, fit_quality(docs, labels), least=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by Jaccard 0.8 or more of five-word shingles."""
    return one_of_each_group(docs, "doc_id", "text", k=5, percent=80, scanned=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources, weighted 1, 2, 3 repeating, takes them."""
    return repeated(docs, scanned=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packed(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: The stages train models, walk links and pack by a plan: SQL cannot state their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
