"""A corpus from documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewatch.llm import line_dedup, mixing, packing, quality, simhash
from ratewatch.llm.text import table
from ratewatch.session import forget, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the isolation forest."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with one line kept of each class of similar lines."""
    return line_dedup.drop_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.copied(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of a document in the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_dedup),
    ("mixing sources", source_mix),
    ("best-fit packing", best_fit_packing),
]

# The forest, the hashes of lines and texts and the random draws are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each but the last is written to the shared folder and read again.

    What a stage wrote is removed when the next one is written.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before = docs
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
