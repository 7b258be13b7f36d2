"""Time expressions. Timestamps are instants; the session zone is UTC."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years 1 to 9999. Anything else is no time of a quote and would overflow.
MIN_MILLIS = -62_135_596_800_000
MAX_MILLIS = 253_402_300_799_999


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp; null where out of range."""
    return F.when(ms.between(MIN_MILLIS, MAX_MILLIS), F.timestamp_millis(ms))


def aligned_window(ts: Column, seconds: int) -> Column:
    """The tumbling window of ``ts`` as a struct, computed per row.

    Equal to ``F.window`` but keeps rows whose ``ts`` is null, as outer joins need.
    """
    size = seconds * 1_000_000
    start = F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(size))
    return F.struct(
        F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + size).alias("end")
    )


def new_york_clock(as_of: Column | None = None) -> Column:
    """The wall clock of New York at ``as_of`` (now by default)."""
    return F.from_utc_timestamp(F.current_timestamp() if as_of is None else as_of, "America/New_York")


def recent_dates(days: int = 0, as_of: date | None = None) -> list[date]:
    """The two end dates of the served range: ``days`` before ``as_of``, and ``as_of``."""
    today = as_of or datetime.now(timezone.utc).date()
    return sorted({today - timedelta(days=days), today})


def date_literals(dates: list[date | str]) -> list[Column]:
    """Dates for ``isin``; given as dates or as yyyy-MM-dd text."""
    return [F.lit(str(day)).cast("date") for day in dates]


def seconds(n: int) -> str:
    """An interval text for ``F.window`` and ``withWatermark``."""
    return f"{n} seconds"
