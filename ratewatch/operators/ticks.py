"""JSON records to typed ticks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.clock import from_millis
from ratewatch.functions.ids import record_id
from ratewatch.operators.framing import unframe
from ratewatch.schemas import FIELD_TYPES, QUOTE_TYPES, TICK_KEY, WIRE_FIELDS


def decode(records: DataFrame, fields: tuple[str, ...] = WIRE_FIELDS, value: str = "value") -> DataFrame:
    """Records as string columns. Name only the fields needed; the rest is not parsed.

    The struct is unpacked by a generator, because a filter on its fields would otherwise
    be pushed below the projection and parse every record a second time.
    """
    kept = [F.col(c) for c in records.columns if c != value]
    schema = ", ".join(f"{name} string" for name in fields)
    return records.select(*kept, F.inline(F.array(F.from_json(F.col(value), schema))))


def with_marker(records: DataFrame) -> DataFrame:
    """Drop records whose marker is empty or missing (text that is no JSON, too)."""
    return records.where("fx_marker != ''")


def typed(records: DataFrame) -> DataFrame:
    """Give wire columns their types; what cannot be read becomes null. Adds ``ts``."""
    columns = [
        F.col(c).try_cast(FIELD_TYPES[c]).alias(c) if c in FIELD_TYPES else F.col(c)
        for c in records.columns
    ]
    return records.select(*columns).withColumn("ts", from_millis(F.col("timestamp_ms")))


def ticks_of(messages: DataFrame, fields: tuple[str, ...] = WIRE_FIELDS) -> DataFrame:
    """Messages to typed ticks: unframe, decode, drop records without marker, type."""
    return typed(with_marker(decode(unframe(messages), fields)))


def rescued(records: DataFrame, fields: tuple[str, ...] = WIRE_FIELDS, value: str = "value") -> DataFrame:
    """Records as typed ticks with ``rescued``: what of them has no place in the columns.

    That is a JSON object (keys in alphabetical order) of all fields beside the named ones,
    nested ones too, and of named fields whose value cannot be typed; their column is null. It
    is null where a record fits. A record that is no JSON object, or repeats a key, has null
    columns and stands in ``rescued`` as it came. Other columns are kept; no row is dropped.
    Each record is parsed once, to a map of variants.
    """
    kept = [F.col(c) for c in records.columns if c != value]
    whole = F.try_variant_get(F.try_parse_json(F.col(value)), "$", "map<string,variant>")
    parsed = records.select(*kept, F.inline(F.array(F.struct(whole.alias("__fields"), F.col(value).alias("__text")))))

    def text(cell: Column) -> Column:
        # A value that is an object or a list is no text.
        nested = F.schema_of_variant(cell).rlike("^(OBJECT|ARRAY)")
        return F.when(~nested, F.try_variant_get(cell, "$", "string"))

    cells = {field: text(F.element_at("__fields", F.lit(field))).try_cast(FIELD_TYPES[field]) for field in fields}

    def misses(name: Column, cell: Column) -> Column:
        known = [(name == F.lit(field)) & F.col(field).isNotNull() for field in fields]
        return ~reduce(or_, known, F.lit(False)) & (~name.isin(*fields) | (F.schema_of_variant(cell) != "VOID"))

    # As a generator, so that typing is not repeated for every use of a column.
    made = F.struct(*[cell.alias(field) for field, cell in cells.items()], "__fields", "__text")
    typed_rows = parsed.select(*kept, F.inline(F.array(made)))
    rest = F.map_filter("__fields", misses)
    kept_text = F.when(F.col("__fields").isNull(), F.col("__text")).when(F.size(rest) > 0, F.to_json(rest))
    rows = typed_rows.withColumn("rescued", kept_text).drop("__fields", "__text")
    return rows.withColumn("ts", from_millis(F.col("timestamp_ms"))) if "timestamp_ms" in fields else rows


def _unreadable(field: str) -> Column:
    cell = F.col(field).try_cast(QUOTE_TYPES[field])
    if field == "fx_marker":
        return F.coalesce(cell == "", F.lit(True))
    if field == "timestamp_ms":
        return from_millis(cell).isNull()
    return cell.isNull()


def _readable() -> Column:
    return ~reduce(or_, map(_unreadable, WIRE_FIELDS))


def valid_ticks(records: DataFrame) -> DataFrame:
    """The records with every field readable, typed."""
    return typed(records.where(_readable()))


def quarantined(records: DataFrame) -> DataFrame:
    """The other records as they came, with the names of their ``bad_fields``.

    Each record is judged for itself; a bad one spoils no other of its message.
    """
    return marked_records(records).where("bad_fields <> ''")


def marked_records(records: DataFrame) -> DataFrame:
    """All records as they came, with the names of their ``bad_fields``: none where readable."""
    names = [F.when(_unreadable(field), F.lit(field)) for field in WIRE_FIELDS]
    return records.withColumn("bad_fields", F.concat_ws(",", *names))


def with_date(ticks: DataFrame) -> DataFrame:
    """Add the calendar date (UTC) that tables are partitioned by."""
    return ticks.withColumn("timestamp_d", F.to_date("ts"))


def with_record_id(rows: DataFrame, keys: tuple[str, ...] = TICK_KEY, random: bool = False) -> DataFrame:
    """Add ``record_id``, by default made from the key so that retries agree."""
    return rows.withColumn("record_id", F.uuid() if random else record_id(rows.schema, *keys))
