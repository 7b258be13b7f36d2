"""Result rows as (key, value) messages, and back to table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.wire import UTC
from ratewatch.schemas import COUNT_VALUE, MEAN_VALUE


def encode(results: DataFrame) -> DataFrame:
    """Key = marker, value = the whole row as JSON (null fields are left out)."""
    return results.select(
        F.col("fx_marker").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in results.columns]), UTC).alias("value"),
    )


def _decoded(messages: DataFrame, schema: str, *values: Column) -> DataFrame:
    """Messages as rows of marker, date, window and ``values``, if all of these are there.

    The ``offset`` of a message is kept, as it tells which of two versions is later.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema, UTC)
    kept = [c for c in messages.columns if c == "offset"]
    rows = messages.select(*kept, parsed.alias("d")).select(
        *kept,
        F.col("d.fx_marker").alias("fx_marker"),
        F.to_date("d.window.start").alias("timestamp_d"),
        F.col("d.window.start").alias("window_start"),
        F.col("d.window.end").alias("window_end"),
        *values,
    )
    return rows.dropna("any", subset=[c for c in rows.columns if c not in kept])


def decode_means(messages: DataFrame) -> DataFrame:
    """Mean messages as table rows; incomplete ones are dropped."""
    return _decoded(
        messages,
        MEAN_VALUE,
        F.col("d.`avg(bid_big)`").alias("bid_big_avg"),
        F.col("d.`avg(bid_points)`").alias("bid_points_avg"),
    )


def decode_anomalies(messages: DataFrame) -> DataFrame:
    """Anomaly messages as table rows; incomplete ones are dropped.

    Messages that carry no ``is_anomaly`` are anomalies; the flag serves update mode.
    """
    return _decoded(
        messages,
        f"{COUNT_VALUE}, is_anomaly boolean",
        F.col("d.count").cast("double").alias("anomaly_count"),
        F.coalesce("d.is_anomaly", F.lit(True)).alias("is_anomaly"),
    )
