"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_UTC_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def parse_event_time(col: str | Column = "timestamp") -> Column:
    """ISO-8601 string (``Z`` or ``+00:00`` offset) to TIMESTAMP; garbage -> null.

    ``try_to_timestamp`` keeps one bad record from failing the query under ANSI.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)


def epoch_millis(ts: str | Column) -> Column:
    """Epoch milliseconds as ``int(seconds_float * 1000)``: microseconds to
    float seconds, times 1000, truncated — the event-time convention of the
    detectors (it can differ by 1 ms from exact integer truncation)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (F.unix_micros(c) / F.lit(1e6) * F.lit(1000.0)).cast("long")


def iso_utc(ts: str | Column) -> Column:
    """TIMESTAMP -> ISO-8601 text with explicit UTC offset and microseconds."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, ISO_UTC_PATTERN)


def to_ntz(ts: str | Column) -> Column:
    """Session-zone (UTC) wall clock as TIMESTAMP_NTZ for zone-free outputs."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c.cast("timestamp_ntz")


def millis_to_days(ms: Column) -> Column:
    """whole days of a retention setting in milliseconds; null and -1
    (unlimited) give null."""
    return F.when(ms >= 0, F.floor(ms / F.lit(86_400_000)))
