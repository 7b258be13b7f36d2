"""The test table ``events`` as ticks, quote lines, records and messages."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.operators import framing
from ratewatch.schemas import WIRE_FIELDS
from ratewatch.session import configure

RESPONSE_LINES = 50


def _at(moment: date | datetime | str):
    return F.lit(str(moment)).cast("timestamp_ntz")


def ticks(
    spark: SparkSession,
    sf_dir: str,
    markers: list[str] | None = None,
    dates: list[date | str] | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Events as ticks; the filters are on stored columns and so reach the scan."""
    events = configure(spark).read.parquet(f"{sf_dir}/events.parquet")
    if markers is not None:
        events = events.where(F.col("event_type").isin(markers))
    if dates is not None:
        days = [date.fromisoformat(str(day)) for day in dates]
        events = events.where((F.col("ts") >= _at(min(days))) & (F.col("ts") < _at(max(days) + timedelta(1))))
    if start is not None:
        events = events.where(F.col("ts") >= _at(start))
    if end is not None:
        events = events.where(F.col("ts") < _at(end))
    cents = (F.round(F.col("value") * 100).cast("bigint") % 100).cast("int")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = events.select(
        "event_id",
        F.col("event_type").alias("fx_marker"),
        ms.alias("timestamp_ms"),
        F.timestamp_millis(ms).alias("ts"),
        F.floor("value").cast("double").alias("bid_big"),
        cents.alias("bid_points"),
        F.floor("value").cast("double").alias("offer_big"),
        F.least(cents + 2, F.lit(99)).alias("offer_points"),
        (F.col("value") + 0.5).alias("hight"),
        (F.col("value") - 0.5).alias("low"),
        F.col("value").alias("open"),
    ).withColumn("timestamp_d", F.to_date("ts"))
    return rows if dates is None else rows.where(F.col("timestamp_d").isin([F.lit(d) for d in days]))


def quote_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote line per event. Error events have no ``open`` and so a field too few."""
    fields = [F.col(c).cast("string") for c in WIRE_FIELDS[:-1]]
    last = F.when(F.col("fx_marker") != "error", F.col("open").cast("string"))
    # As a generator the line is made once, also where a reader filters on it.
    line = F.explode(F.array(F.concat_ws(",", *fields, last)))
    return ticks(spark, sf_dir).select("event_id", line.alias("value"))


def quote_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote lines grouped into responses of at most 50 lines by their unique id."""
    return framing.frame_records(quote_lines(spark, sf_dir), "event_id", RESPONSE_LINES)


def unreadable(rows: DataFrame) -> DataFrame:
    """Ticks with ``bid_points`` as text: "n/a" for sign-ups and empty where they are zero."""
    points = (
        F.when(F.col("fx_marker") == "signup", "n/a")
        .when(F.col("bid_points") == 0, "")
        .otherwise(F.col("bid_points").cast("string"))
    )
    return rows.withColumn("bid_points", points)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String records of which some cannot be typed, see ``unreadable``."""
    texts = [F.col(c).cast("string").alias(c) for c in WIRE_FIELDS if c != "bid_points"]
    return unreadable(ticks(spark, sf_dir)).select("event_id", *texts, "bid_points").select("event_id", *WIRE_FIELDS)


def odd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records of which some have nested fields beside those of a quote, or in their place.

    ``bid_points`` is as in ``unreadable``, ``open`` an object for purchases, and every third
    record has a ``venue``.
    """
    rows = unreadable(ticks(spark, sf_dir))
    attempt = F.struct(F.lit("n/a").alias("last"), (F.col("event_id") % 4).alias("tries"))
    lots = F.array(F.col("event_id") % 5, F.lit(7).cast("long"))
    venue = F.struct(lots.alias("lots"), F.concat(F.lit("v"), (F.col("event_id") % 11).cast("string")).alias("name"))
    fields = [F.to_json(F.struct(c)) for c in WIRE_FIELDS if c != "open"]
    fields.append(
        F.when(F.col("fx_marker") == "purchase", F.to_json(F.struct(attempt.alias("open")))).otherwise(
            F.to_json(F.struct("open"))
        )
    )
    fields.append(F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(venue.alias("venue")))))
    inside = F.concat_ws(",", *[F.substring(f, F.lit(2), F.length(f) - 2) for f in fields])
    return rows.select("event_id", F.concat(F.lit("{"), inside, F.lit("}")).alias("value"))


def messages(rows: DataFrame, size: int = 1) -> DataFrame:
    """Ticks as messages of up to ``size`` JSON records."""
    records = framing.record_json(rows.select("event_id", *WIRE_FIELDS))
    if size == 1:
        return records.withColumnRenamed("event_id", "offset")
    return framing.frame_records(records, "event_id", size)
