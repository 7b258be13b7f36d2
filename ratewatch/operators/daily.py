"""Sums of counts by day that merge to the statistics of any dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.clock import new_york_clock
from ratewatch.operators.counts import on_dates

DAY_SECONDS = 86_400


def day_sums(counts: DataFrame) -> DataFrame:
    """Number, sum and sum of squares of the counts per marker and day.

    A window belongs to the day it starts on; windows must not go over midnight, so their
    duration divides a day. Counts are whole numbers, so the sums are exact and merge by
    adding up, where means and deviations would round. In a stream this is a second
    aggregation on the windows of the first; a day is complete when the watermark has passed it.
    """
    if counts.isStreaming:
        day = F.window(F.window_time("window"), "1 day")
        started = F.to_date("day.start")
    else:
        day = F.to_date("window.start")
        started = F.col("day")
    count = F.col("count").cast("decimal(19,0)")
    sums = counts.groupBy(day.alias("day"), "fx_marker").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("count").alias("total"),
        F.sum(count * count).cast("decimal(38,0)").alias("squares"),
    )
    return sums.select("fx_marker", started.alias("day"), "n", "total", "squares")


def merged_statistics(
    sums: DataFrame, dates: list[date | str] | None = None, as_of: Column | None = None
) -> DataFrame:
    """Mean and sample standard deviation of the counts of the listed dates, or of all.

    Nothing but the sums is read: no tick and no window. One window gives no deviation.
    """
    if dates is not None:
        sums = on_dates(sums, dates, "day")
    merged = sums.groupBy("fx_marker").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")
    )
    n, total = F.col("n").cast("decimal(19,0)"), F.col("total").cast("decimal(19,0)")
    # The difference is exact before it becomes a double.
    spread = (n * F.col("squares") - total * total).cast("double")
    pairs = F.col("n").cast("double") * (F.col("n") - 1)
    return merged.select(
        "fx_marker",
        (F.col("total") / F.col("n")).alias("avg_count"),
        F.when(F.col("n") > 1, F.sqrt(spread / pairs)).alias("stddev_count"),
        new_york_clock(as_of).alias("stat_gathered_date"),
    )
