"""Times, windows and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of an analytics window and windows per run.
WINDOW_MINUTES = 15
RUN_WINDOWS = 3


def next_minute(ts: Column) -> Column:
    """Start of the minute after ``ts``."""
    return F.date_trunc("minute", ts) + F.expr("INTERVAL 1 MINUTE")


def plus_windows(ts: Column, n: int, minutes: int = WINDOW_MINUTES) -> Column:
    """``ts`` moved by ``n`` windows."""
    return ts + F.make_dt_interval(mins=F.lit(n * minutes))


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with microsecond accuracy."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1000000.0)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``; 0 where ``whole`` is not above 0."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))
