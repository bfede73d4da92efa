"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Each stage takes (spark, docs, sf_dir) and returns a table with the columns of
its input; the last repeats rows. Stages work on all rows they are given:
quality rules drop what they reject, line dedup rewrites texts without shared
lines, near dedup keeps one document of each group of near fingerprints,
decontamination drops documents that hold a benchmark item, and mixing repeats
documents to their source's target. Null, empty and repeated rows are treated as
the operators' modules state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmura.llm import contamination, lines, mixing, quality, simhash
from murmura.llm.base import settle
from murmura.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and stay close to their language's references."""
    settle(spark)
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    settle(spark)
    return lines.drop_shared_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group whose fingerprints of three-word shingles link at two differing bits or fewer."""
    settle(spark)
    return simhash.drop_near_copies(docs, budget=2, width=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    settle(spark)
    return contamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target."""
    settle(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix sources", mix_sources),
]

# Fingerprints are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
