"""Windows without ticks, so that a source that falls silent is seen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400


def _seconds(at: Column | datetime | str) -> Column:
    return F.unix_seconds(at if isinstance(at, Column) else F.lit(at).cast("timestamp"))


def silent_windows(
    counts: DataFrame,
    duration: int,
    start: Column | datetime | str,
    end: Column | datetime | str,
    markers: DataFrame | None = None,
    by: str = "fx_marker",
) -> DataFrame:
    """The windows from ``start`` up to ``end`` that ``counts`` lacks, each with a count of 0.

    Windows lie on whole multiples of ``duration`` seconds and count where they start in the
    range. ``markers`` names those that are expected, by default all that have a count; null is
    none. The result has ``window``, the marker and ``count``.

    A marker's windows are compared day by day, as a list of a day's starts without those that
    are taken: a group holds no more than one day's windows, and only the missing ones become
    rows. ``counts`` is read for the starts alone.
    """
    low, high = _seconds(start), _seconds(end)
    counts = counts.where(F.col(by).isNotNull())
    expected = (counts if markers is None else markers.where(F.col(by).isNotNull())).select(by).distinct()
    first = low - F.pmod(low, F.lit(DAY))
    days = expected.where(low < high).withColumn(
        "_day", F.explode(F.sequence(first, high - 1, F.lit(DAY).cast("long")))
    )
    began = F.unix_seconds("window.start")
    taken = (
        counts.where((began >= low) & (began < high))
        .groupBy(by, (began - F.pmod(began, F.lit(DAY))).alias("_day"))
        .agg(F.collect_set(began).alias("_taken"))
    )
    joined = days.join(taken, [by, "_day"], "left")
    begin = F.greatest(F.col("_day"), low)
    begin = begin + F.pmod(-begin, F.lit(duration))
    last = F.least(F.col("_day") + DAY, high) - 1
    none = F.array().cast("array<bigint>")
    starts = F.when(begin <= last, F.sequence(begin, last, F.lit(duration).cast("long")))
    missing = F.array_except(starts, F.coalesce("_taken", none))
    rows = joined.select(by, F.explode(missing).alias("_start"))
    window = F.struct(
        F.timestamp_seconds("_start").alias("start"), F.timestamp_seconds(F.col("_start") + duration).alias("end")
    )
    return rows.select(window.alias("window"), by, F.lit(0).cast("bigint").alias("count"))


def with_silent(
    counts: DataFrame,
    duration: int,
    start: Column | datetime | str | None = None,
    end: Column | datetime | str | None = None,
    markers: DataFrame | None = None,
    by: str = "fx_marker",
) -> DataFrame:
    """``counts`` with a row of 0 for every window without ticks.

    The range is by default that of the first and last window of all markers together, so a
    marker that stops before the others, or starts after them, is silent there. Read ``counts``
    from a stored table then, as it is read once more for the range.
    """
    if start is None:
        start = counts.agg(F.min("window.start")).scalar()
    if end is None:
        end = counts.agg(F.max("window.end")).scalar()
    zeros = silent_windows(counts, duration, start, end, markers, by)
    return counts.select("window", by, "count").unionByName(zeros)
