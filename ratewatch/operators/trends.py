"""Sliding means."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewatch.functions.clock import seconds

BID = ("bid_big", "bid_points")

# Windows of a tick up to which the sum of a slide is simply given to each of them.
FEW_WINDOWS = 8


def sliding_mean(
    ticks: DataFrame,
    duration: int = 30,
    slide: int = 5,
    columns: tuple[str, ...] | None = BID,
    by: tuple[str, ...] = ("fx_marker",),
    ts: str = "ts",
    sum_first: bool = True,
) -> DataFrame:
    """Mean per sliding window of ``duration`` seconds, one every ``slide`` seconds.

    ``columns=None`` averages every numeric column. The result has ``window``, ``by`` and
    ``avg(<column>)``.

    On batch input ticks are first summed per slide; the windows are then built from these
    sums. A tick is so aggregated once instead of once for each of the ``duration / slide``
    windows it lies in. Where these are many, the windows come from sums from the start and
    to the end of each stretch of ``duration`` (``chunk_sums``), and no sum is copied to them.
    ``sum_first=False`` leaves all that out, for ticks so rare that hardly two share a slide.
    """
    types = {f.name: f.dataType for f in ticks.schema}
    if columns is None:
        columns = tuple(c for c in types if isinstance(types[c], T.NumericType) and c not in by)
    window = (seconds(duration), seconds(slide))
    many = duration > FEW_WINDOWS * slide
    if ticks.isStreaming or not sum_first or (duration % slide and not many):
        means = [F.avg(c).alias(f"avg({c})") for c in columns]
        return ticks.groupBy(F.window(ts, *window), *by).agg(*means)

    # As avg does, add whole numbers up as doubles, which do not overflow.
    exact = {c for c in columns if isinstance(types[c], T.DecimalType)}
    sums = [
        F.sum(F.col(c) if c in exact else F.col(c).cast("double")).alias(f"sum({c})") for c in columns
    ]
    sizes = [F.count(c).alias(f"count({c})") for c in columns]
    means = [
        F.try_divide(F.sum(f"sum({c})"), F.sum(f"count({c})")).alias(f"avg({c})") for c in columns
    ]
    if many:
        step = gcd(duration, slide)
        panes = ticks.groupBy(F.window(ts, seconds(step)).alias("pane"), *by).agg(*sums, *sizes)
        panes = panes.withColumn("pane", F.unix_seconds("pane.start"))
        made = [f"{kind}({c})" for c in columns for kind in ("sum", "count")]
        partial = chunk_sums(panes, duration, slide, step, by, tuple(made))
        start = F.timestamp_seconds("start")
        whole = F.struct(start.alias("start"), (start + F.expr(f"interval {duration} seconds")).alias("end"))
        return partial.groupBy("start", *by).agg(*means).select(whole.alias("window"), *by, *[f"avg({c})" for c in columns])
    panes = (
        ticks.groupBy(F.window(ts, seconds(slide)).alias("pane"), *by)
        .agg(*sums, *sizes)
        .withColumn("pane", F.col("pane.start"))
    )
    return panes.groupBy(F.window("pane", *window), *by).agg(*means)


def chunk_sums(
    panes: DataFrame, duration: int, slide: int, step: int, by: tuple[str, ...], columns: tuple[str, ...]
) -> DataFrame:
    """Two parts at most of every window's sums: (start, by, columns), to be added up.

    ``panes`` holds sums per ``step`` seconds that start at ``pane``, in epoch seconds. Time is
    cut into chunks of ``duration``. A window lies in two chunks: it is the end of one, from
    its start on, and the beginning of the next. Both are running sums inside a chunk, one
    from its end and one from its start, so each chunk of a ``by`` is a group of at most
    ``duration / step`` rows and nothing is subtracted: no value spoils a later window.
    A running sum holds from one pane to the next, and stands for the windows between.
    """
    pane, last = F.col("pane"), F.lit(duration - step)
    chunk = (pane - F.pmod(pane, F.lit(duration))).alias("chunk")
    there = panes.select(pane, chunk, *by, *[F.col(f"`{c}`") for c in columns])

    def running(order: Column) -> list[Column]:
        frame = Window.partitionBy(*by, "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return [F.sum(F.col(f"`{c}`")).over(frame).alias(c) for c in columns]

    near = Window.partitionBy(*by, "chunk")
    before = F.coalesce(F.lag("pane").over(near.orderBy("pane")) + step, F.col("chunk"))
    after = F.coalesce(F.lead("pane").over(near.orderBy("pane")) - step, F.col("chunk") + last)
    # A window that ends with its chunk is all in the other part.
    ends = F.least(after, F.col("chunk") + last - step)
    backward = there.select(*by, *running(pane.desc()), before.alias("low"), pane.alias("high"))
    forward = there.select(*by, *running(pane.asc()), (pane - last).alias("low"), (ends - last).alias("high"))
    parts = backward.unionByName(forward)
    # Windows start at whole slides.
    low = F.col("low") + F.pmod(-F.col("low"), F.lit(slide))
    parts = parts.withColumn("low", low).where("low <= high")
    starts = F.explode(F.sequence("low", "high", F.lit(slide).cast("long"))).alias("start")
    return parts.select(*by, starts, *[F.col(f"`{c}`") for c in columns])


def flat(results: DataFrame) -> DataFrame:
    """Replace ``window`` by ``window_start`` and ``window_end``."""
    rest = [F.col(f"`{c}`") for c in results.columns if c != "window"]
    return results.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def mean_rows(means: DataFrame) -> DataFrame:
    """Bid means with the column names of the stored table."""
    return flat(means).withColumnsRenamed(
        {"avg(bid_big)": "bid_big_avg", "avg(bid_points)": "bid_points_avg"}
    )
