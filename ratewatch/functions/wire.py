"""Expressions on the text of quote lines and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewatch.schemas import WIRE_FIELDS

WHITESPACE = " \t\n\r\x0b\x0c"
UTC = {"timeZone": "UTC"}


def strip(text: Column) -> Column:
    """Remove blanks and line ends on both sides (``trim`` removes blanks only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def pieces(text: Column) -> Column:
    """The lines of a text."""
    return F.split(text, "\n")


def fields_of(line: Column) -> Column:
    """The comma-separated fields of a quote line; empty fields at the end count."""
    return F.split(line, ",")


def is_complete(line: Column) -> Column:
    """True where a line has all fields. Further fields are ignored.

    A line has enough commas where the text up to the last one needed is not all of it. A
    null line has none.
    """
    return F.coalesce(F.substring_index(line, ",", len(WIRE_FIELDS) - 1) != line, F.lit(False))


def named_fields(fields: Column) -> list[Column]:
    """The split fields of a complete line as named columns."""
    return [fields[i].alias(name) for i, name in enumerate(WIRE_FIELDS)]


def record_json(fields: Column) -> Column:
    """The split fields of a complete line as a flat JSON record of strings."""
    return F.to_json(F.struct(*named_fields(fields)))
