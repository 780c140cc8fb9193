"""Corpus pipeline: language ID, near-dedup, repeated strings, decontamination, mixture.

Each stage takes the documents its predecessor kept, all its decisions take effect, and its
result is written as Parquet in the shared checkpoint folder and read again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attrition.llm import decontaminate, langid, mixing, neardup, suffixes
from attrition.llm.common import materialize, read
from attrition.session import release


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told without ambiguity."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.keep_one(docs)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier in the corpus."""
    return suffixes.cut_documents(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: chosen documents, once for each epoch, with n_tokens and epoch."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", cut_repeated_strings),
    ("decontamination", drop_benchmark_leaks),
    ("mixture", mix_sources),
]

#: No SQL: learned and iterative stages; tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        release(before)
    return docs
