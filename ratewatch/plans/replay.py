"""Events played back as a stream, slice by slice in time order."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratewatch.session import configure, run_folder
from ratewatch.sources import events
from ratewatch.sources.messages import append_topic, read_topic

# Stretches of time that a replay is cut in, whatever the rows and the machine.
SLICES = 3
HEARTBEAT = "heartbeat"


def time_slices(spark: SparkSession, sf_dir: str, n: int = SLICES) -> list[tuple[datetime, datetime]]:
    """``n`` stretches of time that cover all events, with about the same number of events each."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    inner = F.percentile_approx(micros, [i / n for i in range(1, n)])
    first, last, middle = table.agg(F.min(micros), F.max(micros), inner).first()
    edges = sorted({first, *middle, last + 1})
    times = [datetime(1970, 1, 1) + timedelta(microseconds=edge) for edge in edges]
    return list(pairwise(times))


def heartbeat(spark: SparkSession, at: datetime) -> DataFrame:
    """One record of no real marker, whose time lets the watermark pass all earlier windows."""
    ms = int((at - datetime(1970, 1, 1)).total_seconds() * 1000)
    text = F.to_json(
        F.struct(F.lit(HEARTBEAT).alias("fx_marker"), F.lit(str(ms)).alias("timestamp_ms"))
    )
    return spark.range(1).select(F.lit(-1).cast("bigint").alias("offset"), text.alias("value"))


def replay(
    spark: SparkSession,
    sf_dir: str,
    start: Callable[[DataFrame, str], StreamingQuery],
    close: bool = False,
    frame: int = 1,
    slices: list[tuple[datetime | None, datetime | None]] | None = None,
    records: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Add each slice of events to a topic and run the stream over what is new.

    ``start(messages, folder)`` starts the stream with its checkpoint and tables in
    ``folder``; it is restarted for every slice and goes on from its checkpoint. As a slice
    is a batch, no event comes late, whatever the order of the files within it. ``close``
    ends with a heartbeat, so that append mode gives the last windows, too. A message holds
    up to ``frame`` records; with one there is nothing to bring together. ``slices`` sends
    other stretches of time, in the order given; ``records`` changes the ticks of a slice.
    """
    folder = run_folder(configure(spark), "replay")
    slices = slices or time_slices(spark, sf_dir)
    change = records or (lambda rows: rows)
    batches = [events.messages(change(events.ticks(spark, sf_dir, start=a, end=b)), frame) for a, b in slices]
    if close:
        batches.append(heartbeat(spark, slices[-1][1] + timedelta(days=1)))
    for batch in batches:
        append_topic(batch, f"{folder}/topic")
        query = start(read_topic(spark, f"{folder}/topic", stream=True), folder)
        query.awaitTermination()
    return folder
