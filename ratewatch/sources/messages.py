"""Topics: streams of (key, value) messages.

A topic is a folder of Parquet files here. With the Kafka connector on the class path
the same jobs run on ``format="kafka"``; the operators see the same columns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.schemas import MESSAGE


def read_topic(
    spark: SparkSession, topic: str, format: str = "parquet", stream: bool = False,
    since: datetime | None = None, most: int | None = None, most_bytes: int | None = None, **options: str,
) -> DataFrame:
    """Messages of a topic: a folder, or the name of a Kafka topic.

    ``since`` leaves out messages captured before it, or without a time. A stream takes ``most`` files
    (Kafka: messages) or ``most_bytes`` of files a batch, so that a long backlog is read in
    batches of bounded size, also by a run that takes what is there and stops.
    """
    reader = (spark.readStream if stream else spark.read).format(format).options(**options)
    if stream and most is not None:
        reader = reader.option("maxOffsetsPerTrigger" if format == "kafka" else "maxFilesPerTrigger", most)
    if stream and most_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", most_bytes)
    if since is not None and format == "kafka":
        reader = reader.option("startingTimestamp", str(int(since.timestamp() * 1000)))
        # Offsets of different partitions say nothing about time.
        loaded = reader.option("subscribe", topic).load()
        return loaded.select("key", "value", "offset", "partition", loaded["timestamp"].alias("time"))
    if format == "text":
        return reader.option("wholetext", True).load(topic)
    # A publisher that runs a batch again replaces its files. Those already listed are then
    # gone, and the same messages come as new files.
    reader = reader.option("recursiveFileLookup", True).option("ignoreMissingFiles", True)
    rows = reader.schema(MESSAGE).load(topic)
    return rows if since is None else rows.where(F.col("time") >= F.lit(since))


def spread(messages: DataFrame, partitions: int | None, key: str | None = None) -> DataFrame:
    """Spread messages over topic partitions: evenly, or by key so a key stays in one.

    Keep raw ticks without key: one marker can hold a large share of them.
    """
    if partitions is None:
        return messages
    return messages.repartition(partitions, key) if key else messages.repartition(partitions)


def append_topic(
    messages: DataFrame, topic: str, format: str = "parquet", partitions: int | None = None,
    key: str | None = None, **options: str,
) -> None:
    """Add a batch of messages to a topic."""
    out = messages.withColumn("value", messages["value"].cast("binary"))
    if "key" not in out.columns:
        out = out.selectExpr("cast(null as string) as key", "*")
    if format == "kafka":
        out = out.select("key", "value")
    writer = spread(out, partitions, key).write.format(format).options(**options)
    if format == "kafka":
        writer.option("topic", topic).save()
    else:
        writer.mode("append").save(topic)
