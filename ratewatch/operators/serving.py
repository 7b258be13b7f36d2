"""What a dashboard reads: recent rows, trimming, overlay and report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.clock import aligned_window
from ratewatch.operators.counts import on_dates
from ratewatch.operators.latest import recent

# Fixed value: the column title of the report.
REPORT_TITLE = "Time when anomaly was detected"


def of_markers(rows: DataFrame, markers: str | list[str]) -> DataFrame:
    """Rows of the given markers."""
    return rows.where(F.col("fx_marker").isin([markers] if isinstance(markers, str) else list(markers)))


def of_marker(rows: DataFrame, markers: str | list[str], dates: list[date | str]) -> DataFrame:
    """Rows of the given markers and dates; prunes partitions of stored tables."""
    return on_dates(of_markers(rows, markers), dates)


def recent_ticks(ticks: DataFrame, marker: str, dates: list[date | str], n: int = 100, *tie: str) -> DataFrame:
    """The newest ticks of one marker on the given dates."""
    return recent(of_marker(ticks, marker, dates), n, "ts", *tie)


def recent_results(results: DataFrame, marker: str, dates: list[date | str], n: int = 100) -> DataFrame:
    """The newest means or anomalies of one marker on the given dates."""
    return recent(of_marker(results, marker, dates), n, "window_start")


def since(results: DataFrame, ticks: DataFrame) -> DataFrame:
    """Results whose window starts no earlier than the oldest of ``ticks``.

    The minimum is one value, so it is a scalar subquery and no join.
    """
    oldest = ticks.agg(F.min("ts")).scalar()
    return results.where(F.col("window_start") >= oldest)


def overlay(ticks: DataFrame, anomalies: DataFrame, duration: int = 10) -> DataFrame:
    """Every tick with the anomalous window it lies in, if any.

    Anomalies are aligned windows of ``duration`` seconds, one per marker and start, so
    containment is an equi-join on the tick's own window start. Read ``anomalies`` from a
    stored table: its size is then known, and a small one is broadcast without
    shuffling the ticks.
    """
    marks = anomalies.select(
        "fx_marker",
        F.col("window_start").alias("anomaly_start"),
        F.col("window_end").alias("anomaly_end"),
    )
    start = aligned_window(F.col("ts"), duration)["start"]
    return ticks.withColumn("anomaly_start", start).join(
        marks.withColumn("in_anomaly", F.lit(True)), ["fx_marker", "anomaly_start"], "left"
    ).select(
        *ticks.columns,
        F.when(F.col("in_anomaly"), F.col("anomaly_start")).alias("anomaly_start"),
        "anomaly_end",
        F.coalesce("in_anomaly", F.lit(False)).alias("in_anomaly"),
    )


def report(anomalies: DataFrame, n: int = 10, *tie: str) -> DataFrame:
    """The newest anomalies as the table shown to users."""
    shown = recent(anomalies, n, "window_start", *tie)
    return shown.drop("window_end").withColumnRenamed("window_start", REPORT_TITLE)
