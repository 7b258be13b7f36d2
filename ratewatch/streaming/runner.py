"""How a stream is started: checkpoint, output mode, trigger, state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ratewatch.session import settings

_starting = Lock()

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Run:
    """Settings of one stream.

    ``every`` is a processing-time trigger such as "1 second"; ``once`` handles what is
    there and stops; neither means Spark's default, a batch as soon as the last is done.
    ``state_partitions`` is fixed by the first start, as the checkpoint keeps it; by
    default it is the session's ``spark.sql.shuffle.partitions``. State is kept in RocksDB, so that
    it may outgrow the executors' memory.
    """

    checkpoint: str
    mode: str = "update"
    every: str | None = None
    once: bool = False
    state_partitions: int | None = None
    rocksdb: bool = True
    name: str | None = None


def start(rows: DataFrame, write: Callable[[DataFrame, int], None], run: Run) -> StreamingQuery:
    """Start a stream whose micro-batches go to ``write(batch, batch_id)``."""
    return _start(rows, rows.writeStream.foreachBatch(write), run)


def start_files(rows: DataFrame, path: str, run: Run) -> StreamingQuery:
    """Start a stream into Parquet files; their log tells readers which belong to it."""
    return _start(rows, rows.writeStream.format("parquet").option("path", path), run)


def start_kafka(messages: DataFrame, topic: str, servers: str, run: Run) -> StreamingQuery:
    """Start a stream of (key, value) messages to a Kafka topic; needs its connector."""
    writer = messages.writeStream.format("kafka").option("topic", topic)
    return _start(messages, writer.option("kafka.bootstrap.servers", servers), run)


def _start(rows: DataFrame, writer: DataStreamWriter, run: Run) -> StreamingQuery:
    spark = rows.sparkSession
    conf = {}
    if run.state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(run.state_partitions)
    if run.rocksdb:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        # Commits then write what changed and not all state.
        conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    writer = writer.outputMode(run.mode).option("checkpointLocation", run.checkpoint)
    if run.name:
        writer = writer.queryName(run.name)
    if run.once:
        writer = writer.trigger(availableNow=True)
    elif run.every:
        writer = writer.trigger(processingTime=run.every)
    # A stream takes the session's settings as it starts; starts of several threads take turns.
    with _starting, settings(spark, conf):
        return writer.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, in the batches the query still remembers."""
    states = [state for progress in query.recentProgress for state in progress.stateOperators]
    return sum(state.numRowsDroppedByWatermark for state in states)


def rows_without_time(query: StreamingQuery) -> int:
    """Ticks whose time could not be read, in the batches the query still remembers."""
    seen = [progress.observedMetrics.get("ticks") for progress in query.recentProgress]
    return sum(metrics["without_time"] for metrics in seen if metrics)
