"""The stream jobs: sliding means, count anomalies, storing and publishing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratewatch.functions.clock import seconds
from ratewatch.functions.wire import strip
from ratewatch.operators import counts, daily, envelope, framing, ticks, trends
from ratewatch.schemas import ANOMALY_TABLE, COUNT_FIELDS, MEAN_FIELDS, MEAN_TABLE, TICK_TABLE
from ratewatch.sources.messages import spread
from ratewatch.sources.tables import read_version, write_version
from ratewatch.streaming import sinks
from ratewatch.streaming.runner import Run, start, start_files


Limits = Callable[[SparkSession], DataFrame]


def _timed(rows: DataFrame) -> DataFrame:
    """Ticks with a metric of those whose time cannot be read; no window takes these."""
    return rows.observe("ticks", F.count_if(F.col("ts").isNull()).alias("without_time"))


def mean_messages(
    messages: DataFrame, duration: int = 30, slide: int = 5, watermark: int = 120,
    columns: tuple[str, ...] | None = trends.BID,
) -> DataFrame:
    """Raw messages to mean messages."""
    rows = ticks.ticks_of(messages, MEAN_FIELDS).select("fx_marker", "ts", *trends.BID)
    rows = _timed(rows).withWatermark("ts", seconds(watermark))
    return envelope.encode(trends.sliding_mean(rows, duration, slide, columns))


def window_counts(
    messages: DataFrame, markers: list[str] | None = None, duration: int = 10,
    watermark: int = 60, dedup: bool = False,
) -> DataFrame:
    """Raw messages to tick counts per window, of all markers or of the listed ones."""
    rows = ticks.ticks_of(messages, COUNT_FIELDS)
    if markers is not None:
        rows = rows.where(F.col("fx_marker").isin(markers))
    rows = _timed(rows.select("fx_marker", "ts")).withWatermark("ts", seconds(watermark))
    return counts.tumbling_count(rows, duration, dedup=dedup)


def anomaly_messages(window_count: DataFrame, limits: DataFrame, mode: str = "append") -> DataFrame:
    """Counts to anomaly messages.

    In append mode a window is judged once, when it is complete. In update mode a window
    is judged while it still fills; all windows are then sent with a flag, so that a
    later message takes an early alarm back.
    """
    judged = counts.flagged(window_count, limits)
    if mode == "append":
        judged = judged.where("is_anomaly").drop("is_anomaly")
    return envelope.encode(judged)


def run_means(
    messages: DataFrame, table: str, run: Run, view: str | None = None, n: int = 100, **sizes
) -> StreamingQuery:
    """Sliding means of a raw stream into the table of means.

    With ``view``, the ``n`` newest means of each marker are kept there as well.
    """
    refresh = sinks.refresh(messages.sparkSession, view, MEAN_TABLE, n, "window_start")
    write = sinks.upsert(table, envelope.decode_means, refresh)
    return start(mean_messages(messages, **sizes), write, run)


def run_anomalies(
    messages: DataFrame, limits: DataFrame | Limits, table: str, run: Run,
    view: str | None = None, n: int = 10, **sizes
) -> StreamingQuery:
    """Count anomalies of a raw stream into the table of anomalies.

    With ``view``, the ``n`` newest of each marker are kept there as well; in update mode
    these are windows of which ``is_anomaly`` tells the anomalies.
    """
    refresh = sinks.refresh(messages.sparkSession, view, ANOMALY_TABLE, n, "window_start")
    write = sinks.upsert(table, envelope.decode_anomalies, refresh)
    return run_judged(messages, limits, write, run, **sizes)


def run_judged(
    messages: DataFrame, limits: DataFrame | Limits, write: sinks.Writer, run: Run,
    silent: bool = False, **sizes
) -> StreamingQuery:
    """Anomaly messages of a raw stream to any writer.

    Bounds given as a DataFrame are those of the start. Given as a function of the
    session they are asked for with each batch, so newly gathered statistics are used.

    With ``silent``, in append mode, windows without ticks of a marker that has bounds are
    judged as counts of 0. They are complete when other markers' ticks have let a later window
    be complete; how far that is, is kept beside the checkpoint.
    """
    if silent and run.mode != "append":
        raise ValueError("silent windows are judged when they are complete: use append mode")

    def judge(batch: DataFrame, batch_id: int) -> None:
        # A join may skip counts for which there are no bounds, but Spark commits the state of
        # a batch only if all of it was read. So the batch is written beside the checkpoint, in
        # one of two folders that take turns, and judged from there.
        held, turn = f"{run.checkpoint}-counts", batch_id % 2
        write_version(batch, held, turn)
        counted = read_version(batch.sparkSession, held, turn, batch.schema)
        current = limits if isinstance(limits, DataFrame) else limits(batch.sparkSession)
        if silent:
            counted = sinks.completed(
                counted, current, f"{run.checkpoint}-complete", batch_id, sizes.get("duration", 10)
            )
        write(anomaly_messages(counted, current, run.mode), batch_id)

    return start(window_counts(messages, **sizes), judge, run)


def run_counts(messages: DataFrame, table: str, run: Run, **sizes) -> StreamingQuery:
    """Tick counts of a raw stream into a table."""
    rows = trends.flat(window_counts(messages, **sizes))
    return start(rows.withColumn("timestamp_d", F.to_date("window_start")), sinks.upsert(table), run)


def run_day_sums(messages: DataFrame, table: str, run: Run, **sizes) -> StreamingQuery:
    """Sums of a raw stream's counts by marker and day, written when a day is complete.

    Two aggregations follow each other, so this runs in append mode. Statistics of any dates
    are merged from the table, and no tick is read again.
    """
    return start(daily.day_sums(window_counts(messages, **sizes)), sinks.upsert(table), run)


def run_store_ticks(
    messages: DataFrame, table: str, quarantine: str, run: Run, view: str | None = None, n: int = 100
) -> StreamingQuery:
    """Raw stream into the table of ticks; unreadable records are set aside.

    With ``view``, the ``n`` newest ticks of each marker are kept there as well,
    refreshed by every batch.
    """
    order = tuple(c for c in ("time", "offset", "pos") if c == "pos" or c in messages.columns)
    records = framing.unframe(messages).where(strip(F.col("value")) != "")
    raw = ticks.decode(records.withColumn("record", F.col("value")))
    refresh = sinks.refresh(messages.sparkSession, view, TICK_TABLE, n, "timestamp_ms")
    return start(raw, sinks.store_ticks(table, quarantine, order, f"{run.checkpoint}-marked", refresh), run)


def run_store_results(messages: DataFrame, table: str, run: Run, kind: str) -> StreamingQuery:
    """Result messages ("means" or "anomalies") of a topic into their table."""
    decode = {"means": envelope.decode_means, "anomalies": envelope.decode_anomalies}[kind]
    return start(messages, sinks.upsert(table, decode), run)


def response_messages(responses: DataFrame) -> DataFrame:
    """Captured responses to raw messages, which have no key, with the time of their capture."""
    time = F.col("time") if "time" in responses.columns else F.lit(None).cast("timestamp")
    framed = framing.frame_responses(responses.select("value", time.alias("time")))
    return framed.select(F.lit(None).cast("string").alias("key"), "value", "time")


def run_publish(
    responses: DataFrame, topic: str, run: Run, partitions: int | None = None
) -> StreamingQuery:
    """Captured responses as raw messages to a topic, spread evenly over its partitions.

    Spark's own file sink writes them: a batch that runs again after a failure adds nothing
    that readers would take a second time.
    """
    framed = response_messages(responses).withColumn("value", F.col("value").cast("binary"))
    return start_files(spread(framed, partitions), topic, run)


def run_quarantine(responses: DataFrame, quarantine: str, run: Run) -> StreamingQuery:
    """The incomplete lines of captured responses, set aside; a stream of its own."""
    return start_files(framing.rejected_lines(responses.select("value")), quarantine, run)


def run_publish_results(
    results: DataFrame, topic: str, run: Run, partitions: int | None = None
) -> StreamingQuery:
    """Mean or anomaly messages to a topic, spread over its partitions by marker.

    By default there are as many partitions as the session has for shuffles.
    """
    if partitions is None:
        partitions = int(results.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return start(results, sinks.publish(topic, partitions, "key"), run)
