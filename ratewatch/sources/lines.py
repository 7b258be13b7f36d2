"""Captured quote text, as batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quote_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One quote line per row."""
    return (spark.readStream if stream else spark.read).text(path)


def quote_responses(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One captured response (a small file of several lines) per row, with the file's time.

    Each batch lists the whole folder; move files away once they are taken, or let Spark do
    it (``cleanSource``).
    """
    files = (spark.readStream if stream else spark.read).text(path, wholetext=True)
    return files.select("value", F.col("_metadata.file_modification_time").alias("time"))
