"""Corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Every stage takes what its predecessor kept, written as Parquet and read again, and all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exportkit.llm import packing, quality, secretscan, simhash, suffixes
from exportkit.llm.common import written


def _rewritten(docs: DataFrame, result: DataFrame, text: Column) -> DataFrame:
    """The carried rows of ``result`` in the columns of ``docs``, with a new text and its length."""
    rows = result.select("carried.*", text.alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    judged = quality.judge(docs, carry=True).where("kept")
    return _rewritten(docs, judged, F.col("cleaned_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that occur elsewhere are cut out; a character cut in two goes whole."""
    return _rewritten(docs, suffixes.deduplicate(docs, carry=True), F.col("kept_text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _rewritten(docs, secretscan.scan(docs, carry=True), F.col("redacted"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the remaining texts, one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secrets),
    ("packing", sequences),
]

# SQL cannot express fingerprints, suffix arrays, compression or tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
