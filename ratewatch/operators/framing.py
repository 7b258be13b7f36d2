"""Quote lines and the messages that carry several records each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.functions import wire
from ratewatch.schemas import WIRE_FIELDS


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Complete quote lines as nine string columns; other columns are kept."""
    kept = [F.col(c) for c in lines.columns if c != line]
    fields = wire.named_fields(wire.fields_of(F.col(line)))
    return lines.where(wire.is_complete(F.col(line))).select(*kept, *fields)


def quarantine_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """The lines that ``parse_lines`` leaves out, with the number of their fields (null: 0)."""
    count = F.when(F.col(line).isNull(), 0).otherwise(F.size(wire.fields_of(F.col(line))))
    return lines.where(~wire.is_complete(F.col(line))).withColumn("n_fields", count)


def frame_responses(responses: DataFrame, text: str = "value") -> DataFrame:
    """One message per response: its complete lines as JSON records, one per line.

    Each response is handled in its own row, so nothing is shuffled. Responses
    without a complete line give no message.
    """
    complete = F.filter(wire.pieces(wire.strip(F.col(text))), wire.is_complete)
    # Two steps, as a line would otherwise be split again for each of its fields.
    fields = F.transform(complete, wire.fields_of)
    message = F.array_join(F.transform(fields, wire.record_json), "\n")
    # As a generator the message is made once, also with the filter on it.
    kept = [F.col(c) for c in responses.columns if c != text]
    framed = responses.select(*kept, F.explode(F.array(message)).alias(text))
    return framed.where(F.col(text) != "")


def rejected_lines(responses: DataFrame, text: str = "value") -> DataFrame:
    """The lines of responses that ``frame_responses`` leaves out, except blank ones."""
    lines = responses.select(F.explode(wire.pieces(wire.strip(F.col(text)))).alias("value"))
    return quarantine_lines(lines.where(wire.strip(F.col("value")) != ""))


def frame_records(records: DataFrame, seq: str, size: int, value: str = "value") -> DataFrame:
    """Join up to ``size`` records into one message, in the order of ``seq``.

    ``seq`` is a whole number that is unique per record, so a message holds at most
    ``size`` records however the data is spread. The message's number is ``offset``.
    """
    item = F.struct(F.col(seq).alias("seq"), F.col(value).alias("value"))
    return (
        records.groupBy(F.expr(f"`{seq}` div {size}").alias("offset"))
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select("offset", F.array_join(F.col("items.value"), "\n").alias(value))
    )


def record_json(records: DataFrame, fields: tuple[str, ...] = WIRE_FIELDS) -> DataFrame:
    """Replace the wire fields by one JSON record of strings in ``value``."""
    kept = [F.col(c) for c in records.columns if c not in fields]
    texts = [F.col(c).cast("string").alias(c) for c in fields]
    return records.select(*kept, F.to_json(F.struct(*texts)).alias("value"))


def unframe(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per record of each message, with its position ``pos`` in the message."""
    kept = [F.col(c) for c in messages.columns if c not in (value, "key")]
    text = F.col(value).cast("string")
    return messages.select(*kept, F.posexplode(wire.pieces(text)).alias("pos", value))
