"""Field names and schemas of the wire records and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a quote in wire order, with the type each is stored as.
# "hight" is spelt this way on the wire.
QUOTE_TYPES = {
    "fx_marker": "string",
    "timestamp_ms": "bigint",
    "bid_big": "double",
    "bid_points": "int",
    "offer_big": "double",
    "offer_points": "int",
    "hight": "double",
    "low": "double",
    "open": "double",
}

# Optional count bounds that a producer may add to a record.
BOUND_TYPES = {"stream_stat_min": "double", "stream_stat_max": "double"}

WIRE_FIELDS = tuple(QUOTE_TYPES)
BOUND_FIELDS = tuple(BOUND_TYPES)
FIELD_TYPES = {**QUOTE_TYPES, **BOUND_TYPES}

# What the jobs read of a record: the parser skips every other field.
MEAN_FIELDS = ("fx_marker", "timestamp_ms", "bid_big", "bid_points")
COUNT_FIELDS = ("fx_marker", "timestamp_ms")

# Last write wins within these keys.
TICK_KEY = ("fx_marker", "timestamp_d", "timestamp_ms")
RESULT_KEY = ("fx_marker", "timestamp_d", "window_start")
STATISTICS_KEY = ("fx_marker", "stat_gathered_date")

_TYPES = {
    "binary": T.BinaryType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(38, 0),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def columns(**types: str) -> T.StructType:
    """A schema from column names and type names; needs no session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in types.items()])


# (key, value) messages. "time" is when a message was captured, "offset" orders messages where
# the source knows an order; either may be null.
MESSAGE = columns(key="string", value="binary", offset="bigint", time="timestamp")

# Values of result messages.
MEAN_VALUE = (
    "window struct<start: timestamp, end: timestamp>, fx_marker string, "
    "`avg(bid_big)` double, `avg(bid_points)` double"
)
COUNT_VALUE = "window struct<start: timestamp, end: timestamp>, fx_marker string, count bigint"

_WINDOW = {
    "fx_marker": "string",
    "timestamp_d": "date",
    "window_start": "timestamp",
    "window_end": "timestamp",
}
TICK_TABLE = columns(
    fx_marker="string",
    timestamp_ms="bigint",
    timestamp_d="date",
    ts="timestamp",
    **{name: kind for name, kind in QUOTE_TYPES.items() if name not in ("fx_marker", "timestamp_ms")},
)
MEAN_TABLE = columns(**_WINDOW, bid_big_avg="double", bid_points_avg="double")
COUNT_TABLE = columns(**_WINDOW, count="bigint")
ANOMALY_TABLE = columns(**_WINDOW, anomaly_count="double", is_anomaly="boolean")
STATISTICS_TABLE = columns(
    fx_marker="string", stat_gathered_date="timestamp", avg_count="double", stddev_count="double"
)

# Sums of a day's counts; last write wins within marker and day.
DAY_TABLE = columns(fx_marker="string", day="date", n="bigint", total="bigint", squares="decimal")
DAY_KEY = ("fx_marker", "day")


def versioned(table: T.StructType) -> T.StructType:
    """The table's schema with the number of the batch that wrote each row."""
    return T.StructType([*table.fields, T.StructField("batch_id", T.LongType())])
