"""Event-time windows. The same expressions serve tables and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.times import RUN_WINDOWS, WINDOW_MINUTES, plus_windows


def with_window(df: DataFrame, ts: str = "timestamp", minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Add ``window_start`` and ``window_end`` of the tumbling window of ``ts``."""
    window = F.window(F.col(ts), f"{minutes} minutes")
    return (
        df.withColumn("_window", window)
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )


def tumbling_counts(df: DataFrame, ts: str = "timestamp", minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Rows per tumbling window."""
    return (
        df.groupBy(F.window(F.col(ts), f"{minutes} minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count"
        )
    )


def since(df: DataFrame, start: datetime | Column, ts: str = "timestamp") -> DataFrame:
    """Rows at or after ``start``."""
    return df.where(F.col(ts) >= F.lit(start))


def bounded_run(
    df: DataFrame,
    start: datetime | Column,
    ts: str = "timestamp",
    windows: int = RUN_WINDOWS,
    minutes: int = WINDOW_MINUTES,
) -> DataFrame:
    """Rows of a run of ``windows`` windows from ``start`` on.

    A plain range filter, so it reaches the scan and prunes files by time.
    """
    begin = F.lit(start)
    return since(df, begin, ts).where(F.col(ts) < plus_windows(begin, windows, minutes))


def with_run(
    df: DataFrame,
    start: datetime | Column,
    ts: str = "timestamp",
    windows: int = RUN_WINDOWS,
    minutes: int = WINDOW_MINUTES,
) -> DataFrame:
    """Add ``run`` and ``window_no`` for back-to-back runs of ``windows`` windows, both
    from 1; rows before ``start`` belong to no run and are dropped."""
    micros = F.unix_micros(F.col(ts)) - F.unix_micros(F.lit(start))
    index = F.floor(micros / F.lit(minutes * 60 * 1_000_000)).cast("int")
    return (
        since(df, start, ts)
        .withColumn("run", F.floor(index / windows).cast("int") + 1)
        .withColumn("window_no", F.pmod(index, F.lit(windows)) + 1)
    )
