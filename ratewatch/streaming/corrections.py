"""Results of windows whose ticks came too late for the stream, taken from the table of ticks."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewatch.operators import counts, trends
from ratewatch.operators.latest import latest
from ratewatch.schemas import COUNT_TABLE, MEAN_TABLE, RESULT_KEY, TICK_KEY, TICK_TABLE
from ratewatch.session import stored
from ratewatch.sources import tables

Recompute = Callable[[DataFrame], DataFrame]


def counted(duration: int = 10) -> Recompute:
    """Ticks to rows of the table of counts."""

    def rows(ticks: DataFrame) -> DataFrame:
        flat = trends.flat(counts.tumbling_count(ticks, duration))
        return flat.withColumn("timestamp_d", F.to_date("window_start")).select(*COUNT_TABLE.names)

    return rows


def averaged(duration: int = 30, slide: int = 5) -> Recompute:
    """Ticks to rows of the table of means; a mean of nothing is no row, as in the stream's table."""

    def rows(ticks: DataFrame) -> DataFrame:
        means = trends.mean_rows(trends.sliding_mean(ticks, duration, slide))
        dated = means.withColumn("timestamp_d", F.to_date("window_start")).select(*MEAN_TABLE.names)
        return dated.dropna("any", subset=["bid_big_avg", "bid_points_avg"])

    return rows


def correct(
    spark: SparkSession,
    ticks: str,
    results: str,
    corrections: str,
    recompute: Recompute,
    schema: T.StructType,
    duration: int = 10,
    watermark: int = 60,
    compacted: str | None = None,
) -> DataFrame | None:
    """Compute again the windows that newly stored ticks touch, and keep what differs.

    A stream drops ticks behind its watermark, but the table of ticks keeps them. Each run
    takes the ticks of the batches since the last run, reads the marker-days they lie in
    (and those next to them, as far as a window goes), and computes the windows that hold a
    moment of such a day. Of these, the windows that ended ``watermark`` seconds before the
    newest tick are compared with the stored result; those that differ, or have none, go to
    ``corrections`` as the newest version. The cost follows what is new and not the history,
    and a run that is repeated writes the same. The table of ticks holds one tick per marker and time,
    so a corrected window takes repeats once. Gives the corrections, or None without new ticks.
    """
    done = max(tables.numbers(spark, corrections, "batch_id"), default=-1)
    versions = tables.read_versions(spark, ticks, TICK_TABLE, compacted)
    new = versions.where(F.col("batch_id") > done)
    upto, newest = new.agg(F.max("batch_id")).first()[0], versions.agg(F.max("ts")).first()[0]
    if upto is None:
        return None
    days = stored(new.select("fx_marker", "timestamp_d").distinct(), "touched")
    reach = -(-duration // 86_400)
    around = F.sequence(F.date_sub("timestamp_d", reach), F.date_add("timestamp_d", reach))
    read = days.select("fx_marker", F.explode(around).alias("timestamp_d")).distinct()
    held = tables.read_latest(spark, ticks, TICK_TABLE, TICK_KEY, compacted=compacted)
    rows = recompute(held.join(read, ["fx_marker", "timestamp_d"], "left_semi"))
    rows = rows.where(F.col("window_end") <= F.lit(newest - timedelta(seconds=watermark)))
    # A window touches every day it has a moment of.
    last = F.to_date(F.col("window_end") - F.expr("interval 1 microsecond"))
    spans = rows.withColumn("_day", F.explode(F.sequence(F.to_date("window_start"), last)))
    touched = spans.join(days.withColumnRenamed("timestamp_d", "_day"), ["fx_marker", "_day"], "left_semi")
    touched = stored(touched.drop("_day").dropDuplicates(list(RESULT_KEY)).select(*schema.names), "recomputed")
    now = read_corrected(spark, results, corrections, schema)
    same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in schema.names]
    changed = touched.alias("new").join(now.alias("old"), same, "left_anti")
    tables.write_version(changed, corrections, upto)
    return tables.read_version(spark, corrections, upto, schema)


def read_corrected(spark: SparkSession, results: str, corrections: str, schema: T.StructType) -> DataFrame:
    """The stored results, and for windows that have one the last correction in their place."""
    rows = tables.read_latest(spark, results, schema, RESULT_KEY).withColumn("_order", F.lit(-1).cast("bigint"))
    if tables.numbers(spark, corrections, "batch_id"):
        better = tables.read_latest(spark, corrections, schema, RESULT_KEY)
        rows = rows.unionByName(better.withColumn("_order", F.col("batch_id")))
    return latest(rows.drop("batch_id"), RESULT_KEY, "_order").select(*schema.names)
