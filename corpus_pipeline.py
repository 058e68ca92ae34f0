"""The corpus pipeline: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, line_dedup, near_dedup, quality_rules
from lakeloom.llm.common import given, kept_rows, written
from lakeloom.llm.queries import digests
from lakeloom.session import prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; trusted are those labelled 1."""
    trusted = given(prepare(spark), sf_dir, "labels").where("quality = 1")
    return quality_rules.keep_good(docs, quality_rules.fit(docs, trusted))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; those of nothing else go."""
    prepare(spark)
    cleaned = line_dedup.drop_boilerplate(docs)
    return kept_rows(cleaned, F.col("text") != "").withColumn("n_chars", F.char_length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, given(prepare(spark), sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the tokens of each document."""
    prepare(spark)
    return digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("decontaminate", benchmark),
    ("bpe", tokens),
]

# Hashed n-grams, MinHash, edit distance and byte-pair merges are beyond SQL; tests hold the stages
# against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
