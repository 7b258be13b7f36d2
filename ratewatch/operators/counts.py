"""Tick counts per window, their statistics, and counts out of bounds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.clock import date_literals, new_york_clock, seconds
from ratewatch.operators.latest import latest

MARKER = ("fx_marker",)


def tumbling_count(
    ticks: DataFrame,
    duration: int = 10,
    by: tuple[str, ...] = MARKER,
    ts: str = "ts",
    dedup: bool = False,
) -> DataFrame:
    """Ticks per window and ``by``, as ``window``, ``by`` and ``count``.

    Windows without ticks give no row. ``dedup`` counts ticks of one time once.
    """
    if dedup:
        ticks = ticks.dropDuplicates([*by, ts])
    return ticks.groupBy(F.window(ts, seconds(duration)), *by).count()


def on_dates(rows: DataFrame, dates: list[date | str], column: str = "timestamp_d") -> DataFrame:
    """Keep rows of the listed dates; prunes partitions of stored tables."""
    return rows.where(F.col(column).isin(date_literals(dates)))


def statistics(counts: DataFrame, *by: str, as_of: Column | None = None) -> DataFrame:
    """Mean and sample standard deviation of the counts, per ``by`` or over all."""
    return (
        counts.groupBy(*by)
        .agg(F.avg("count").alias("avg_count"), F.stddev("count").alias("stddev_count"))
        .withColumn("stat_gathered_date", new_york_clock(as_of))
    )


def marker_statistics(
    history: DataFrame,
    marker: str,
    dates: list[date | str],
    duration: int = 10,
    as_of: Column | None = None,
    dedup: bool = False,
) -> DataFrame:
    """Count statistics of one marker on the listed dates, as one row."""
    ticks = on_dates(history.where(F.col("fx_marker") == marker), dates).select("ts")
    counts = tumbling_count(ticks, duration, by=(), dedup=dedup)
    return statistics(counts, as_of=as_of).withColumn("fx_marker", F.lit(marker))


def all_statistics(
    history: DataFrame,
    dates: list[date | str],
    duration: int = 10,
    as_of: Column | None = None,
    dedup: bool = False,
) -> DataFrame:
    """Count statistics of every marker on the listed dates."""
    ticks = on_dates(history, dates).select("fx_marker", "ts")
    return statistics(tumbling_count(ticks, duration, dedup=dedup), "fx_marker", as_of=as_of)


def latest_statistics(stats: DataFrame) -> DataFrame:
    """The statistics gathered last for each marker."""
    return latest(stats, MARKER, "stat_gathered_date")


def bounds(stats: DataFrame, k: float = 2.0) -> DataFrame:
    """Count bounds: mean -/+ ``k`` standard deviations."""
    spread = F.lit(float(k)) * F.col("stddev_count")
    return stats.select(
        "fx_marker",
        (F.col("avg_count") - spread).alias("stream_stat_min"),
        (F.col("avg_count") + spread).alias("stream_stat_max"),
    )


def outside(count: str = "count", low: str = "stream_stat_min", high: str = "stream_stat_max") -> Column:
    """True where the count lies below or above its bounds; a null bound never fires."""
    return (F.col(count) < F.col(low)) | (F.col(count) > F.col(high))


def flagged(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """Counts of markers that have bounds, with ``is_anomaly``.

    The bounds are joined after counting, so windows do not split when bounds change.
    No broadcast is forced: Spark broadcasts the bounds where their size allows it.
    """
    joined = counts.join(limits, "fx_marker")
    flag = F.coalesce(outside(), F.lit(False)).alias("is_anomaly")
    return joined.select(*counts.columns, flag)


def anomalies(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """The counts that leave the bounds of their marker."""
    return flagged(counts, limits).where("is_anomaly").drop("is_anomaly")


def anomalies_in_message(ticks: DataFrame, duration: int = 10) -> DataFrame:
    """Anomalies against bounds that come with the ticks themselves."""
    by = ("fx_marker", "stream_stat_min", "stream_stat_max")
    counts = tumbling_count(ticks, duration, by)
    return counts.where(outside()).drop("stream_stat_min", "stream_stat_max")
