"""Row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(key: str, kind: T.DataType) -> Column:
    """A key as text; a timestamp as its microseconds, which no session zone changes."""
    column = F.unix_micros(key) if isinstance(kind, T.TimestampType) else F.col(key)
    return column.cast("string")


def record_id(schema: T.StructType, *keys: str) -> Column:
    """An id made from the key columns, so that a retried write gives the same id."""
    return F.sha2(F.concat_ws("|", *[_text(key, schema[key].dataType) for key in keys]), 256)


def time_id(millis: Column, schema: T.StructType, *keys: str) -> Column:
    """A UUID of version 7 whose order is that of ``millis``, made from the key columns.

    The first 48 bits are the time in epoch milliseconds, the others a hash of the key, so
    ids sort as times do, retries agree, and writers need not know of each other. Null for a time that is
    missing, before 1970 or beyond 48 bits.
    """
    time = F.lpad(F.lower(F.hex(millis)), 12, "0")
    key = record_id(schema, *keys)
    # The two bits of the variant, and two of the hash.
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(key, 1, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    parts = [
        F.substring(time, 1, 8),
        F.substring(time, 9, 4),
        F.concat(F.lit("7"), F.substring(key, 2, 3)),
        F.concat(variant, F.substring(key, 5, 3)),
        F.substring(key, 8, 12),
    ]
    return F.when(millis.between(0, 2**48 - 1), F.concat_ws("-", *parts))
