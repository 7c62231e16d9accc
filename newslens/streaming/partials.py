"""Windowed metrics of a stream from partial counts.

Each micro-batch counts its own words, sentiments and sources and stores these counts by
window. When the watermark has passed a window, its partial counts are summed, ranked and
written as metric rows. What the stream has to remember from batch to batch is one row, its
clock; the words of open windows lie in files, are read once, by the batch that closes them,
and no state store holds them.

Everything a batch writes goes to a folder of its own number, and depends on the batch and on
what earlier batches left only. A batch that is tried again replaces its own rows, so a
failure or a restart adds nothing.

Folders under the partials folder:

* ``open``: partial counts by date; a date is deleted once all its windows are closed and the
  batch that closed them is done;
* ``counts``: full counts of closed windows by date, the history that exact answers read;
* ``late``: messages that came after their window was closed, by window;
* ``clock``: the greatest time seen, of the last two batches.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslens.functions.times import RUN_WINDOWS, WINDOW_MINUTES
from newslens.operators import metrics as M
from newslens.operators import summaries as Sum
from newslens.operators.windows import bounded_run, with_window
from newslens.operators.words import STREAM_TOP, count_words, long_words
from newslens.sources.sinks import drop_metrics, stream_id, write_metrics, write_step
from newslens.streaming.analytics import LATENESS, OPEN_WINDOWS, TRIGGER, write_timing

COUNTS = "window_start timestamp, window_end timestamp, metric_name string, key string, count bigint, total_length bigint"
WINDOW = ["window_start", "window_end"]
#: No time has been seen yet.
NEVER = -(1 << 62)


def window_counts(framed: DataFrame) -> DataFrame:
    """Counts per window, metric and key of articles with their window: words and the rest apart,
    so that a word is hashed as it is and no metric name travels with it."""
    words = count_words(long_words(framed, WINDOW), WINDOW).select(
        *WINDOW, F.lit(M.WORDS).alias("metric_name"), F.col("word").alias("key"), "count",
        F.lit(None).cast("bigint").alias("total_length"),
    )
    by_source = F.grouping("sentiment") == 1
    rest = framed.select(*WINDOW, "source", "sentiment", F.length("content").alias("chars")).groupingSets(
        [[*WINDOW, "source"], [*WINDOW, "sentiment"]], *WINDOW, "source", "sentiment"
    ).agg(
        F.when(by_source, M.SOURCES).otherwise(M.SENTIMENTS).alias("metric_name"),
        F.when(by_source, F.col("source")).otherwise(F.col("sentiment")).alias("key"),
        F.count(F.lit(1)).alias("count"),
        F.when(by_source, F.sum(F.col("chars").cast("bigint"))).alias("total_length"),
    )
    return words.unionByName(rest.select(*words.columns))


def added(counts: DataFrame) -> DataFrame:
    """Partial counts summed per window, metric and key."""
    return counts.groupBy(*WINDOW, "metric_name", "key").agg(
        F.sum("count").alias("count"), F.sum("total_length").alias("total_length")
    )


def micros(time: Column) -> Column:
    return F.unix_micros(time)


def _table(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """A stored table; an empty one if nothing has been stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], layout)


def open_counts(spark: SparkSession, partials: str) -> DataFrame:
    return _table(spark, f"{partials}/open", f"{COUNTS}, window_date date, run string, epoch_id bigint")


def closed_counts(spark: SparkSession, partials: str) -> DataFrame:
    return _table(spark, f"{partials}/counts", f"{COUNTS}, window_date date, run string, epoch_id bigint")


def late_counts(spark: SparkSession, partials: str) -> DataFrame:
    """(window_start, window_end, count) of messages that were too late, summed over batches."""
    rows = _table(spark, f"{partials}/late", "window_start timestamp, window_end timestamp, count bigint")
    return rows.groupBy(*WINDOW).agg(F.sum("count").alias("count"))


def clock(spark: SparkSession, partials: str, run: str, before: int | None = None) -> dict:
    """The last clock row of a run (before a batch): ``seen`` and what it has closed up to."""
    rows = _table(spark, f"{partials}/clock", "seen bigint, closed bigint, run string, epoch_id bigint")
    rows = rows.where(F.col("run") == run)
    if before is not None:
        rows = rows.where(F.col("epoch_id") < before)
    last = rows.orderBy(F.desc("epoch_id")).select("epoch_id", "seen", "closed").first()
    return last.asDict() if last else {"epoch_id": None, "seen": NEVER, "closed": NEVER}


def all_counts(spark: SparkSession, partials: str) -> DataFrame:
    """Counts of every window of every run so far: closed ones in full, open ones in parts."""
    clocks = _table(spark, f"{partials}/clock", "seen bigint, closed bigint, run string, epoch_id bigint")
    marks = clocks.groupBy("run").agg(F.max("closed").alias("closed"))
    still = open_counts(spark, partials).join(marks, "run", "left").where(
        micros(F.col("window_end")) > F.coalesce("closed", F.lit(NEVER))
    )
    columns = [*WINDOW, "metric_name", "key", "count", "total_length"]
    return closed_counts(spark, partials).select(*columns).unionByName(still.select(*columns))


def _dated(counts: DataFrame) -> DataFrame:
    """Counts with their date, the rows of a date in few tasks: else each task would write a file
    for each date. Of a date that is large several tasks take a part."""
    return counts.withColumn("window_date", F.to_date("window_start")).hint("rebalance", F.col("window_date"))


def _drop(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _finished_dates(counts: DataFrame, run: str, closed: int) -> list[str]:
    """Dates of a run all of whose windows are closed: few, as they are deleted one batch later."""
    # The day itself is over: a filter on folders, so no file of an open day is read.
    day_over = F.date_add("window_date", 1) <= F.to_date(F.timestamp_micros(F.lit(max(closed, 0))))
    old = counts.where((F.col("run") == run) & day_over)
    dates = old.groupBy("window_date").agg(F.max(micros(F.col("window_end"))).alias("last"))
    return [str(r["window_date"]) for r in dates.where(F.col("last") <= closed).select("window_date").collect()]


def write_windows(counts: DataFrame, path: str, run: str, epoch_id: int, top: int, listed: int) -> None:
    """Metric rows of whole windows: rankings, sentiments, sources, and the summary of their words."""
    rows = M.metric_rows(M.report(counts, top, by=WINDOW), "streaming")
    words = counts.where(F.col("metric_name") == M.WORDS).withColumnRenamed("key", "word")
    summary = Sum.summary_rows(Sum.summarise(words, WINDOW, listed), "streaming")
    write_metrics(rows.unionByName(summary), path, run, epoch_id)


def partial_writer(
    path: str,
    partials: str,
    start: datetime | Column | None = None,
    windows: int | None = RUN_WINDOWS,
    minutes: int = WINDOW_MINUTES,
    lateness: str = LATENESS,
    top: int = STREAM_TOP,
    listed: int = Sum.LISTED,
    timing_path: str | None = None,
    score: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Callback that stores the partial counts of a micro-batch and the windows it closes.

    ``score`` labels the articles of a batch where the stream does not carry labels yet; a
    batch is a table, so it may join a lexicon of any size.
    """

    length: list[int] = []

    def write(batch: DataFrame, epoch_id: int) -> None:
        began, spark, run = time.time(), batch.sparkSession, stream_id(batch)
        if not length:
            length.append(spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {lateness}) AS n").first()["n"])
        behind = length[0]
        batch.persist()
        try:
            last = clock(spark, partials, run, epoch_id)
            # What the batch before this one closed is settled; its dates are not needed again.
            for date in _finished_dates(open_counts(spark, partials), run, last["closed"]):
                _drop(spark, f"{partials}/open/window_date={date}/run={run}")
            newest = batch.agg(F.max(micros(F.col("timestamp"))).alias("seen")).first()["seen"]
            seen = max(last["seen"], NEVER if newest is None else newest)
            closed = max(last["closed"], seen - behind if seen > NEVER else NEVER)

            framed = with_window(batch.where("timestamp IS NOT NULL"), minutes=minutes)
            if start is not None and windows is not None:
                framed = bounded_run(framed, start, windows=windows, minutes=minutes)
            late = micros(F.col("window_end")) <= last["closed"]
            missed = framed.where(late).groupBy(*WINDOW).agg(F.count(F.lit(1)).alias("count"))
            write_step(missed, f"{partials}/late", run, epoch_id)
            timely = framed.where(~late)
            counts = window_counts(score(timely) if score else timely)
            write_step(_dated(counts), f"{partials}/open", run, epoch_id, ("window_date",))

            done = micros(F.col("window_end")).between(last["closed"] + 1, closed)
            ready = open_counts(spark, partials).where((F.col("run") == run) & (F.col("epoch_id") <= epoch_id) & done)
            if not ready.isEmpty():
                write_step(_dated(added(ready)), f"{partials}/counts", run, epoch_id, ("window_date",))
                # Read back rather than kept: the counts of a long batch are many.
                whole = closed_counts(spark, partials).where((F.col("run") == run) & (F.col("epoch_id") == epoch_id))
                write_windows(whole, path, run, epoch_id, top, listed)
                if timing_path:
                    write_timing(whole, began, timing_path, run, epoch_id)
            tick = spark.range(1).select(F.lit(seen).cast("bigint").alias("seen"), F.lit(closed).cast("bigint").alias("closed"))
            write_step(tick, f"{partials}/clock", run, epoch_id)
            _drop(spark, f"{partials}/clock/run={run}/epoch_id={epoch_id - 2}")
        finally:
            batch.unpersist()

    return write


def start_partial_analytics(
    scored: DataFrame,
    path: str,
    partials: str,
    checkpoint: str,
    trigger: dict[str, str | bool] | None = None,
    lateness: str = LATENESS,
    **options,
) -> StreamingQuery:
    """Start the job. The watermark is declared for progress reports; the batches keep their own clock."""
    return (
        scored.withWatermark("timestamp", lateness)
        .writeStream.outputMode("append")
        .foreachBatch(partial_writer(path, partials, lateness=lateness, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


def write_open_windows(
    spark: SparkSession,
    query: StreamingQuery,
    path: str,
    partials: str,
    top: int = STREAM_TOP,
    listed: int = Sum.LISTED,
    timing_path: str | None = None,
) -> None:
    """Metric rows of the windows that are still open when a stream has ended.

    They are stored as provisional: a row that a later batch of the same stream writes for the
    same window takes their place when results are read (``metrics.latest``).
    """
    began, run = time.time(), str(query.id)
    closed = clock(spark, partials, run)["closed"]
    still = open_counts(spark, partials).where((F.col("run") == run) & (micros(F.col("window_end")) > closed))
    drop_metrics(spark, path, "streaming", run, OPEN_WINDOWS)
    whole = added(still).persist()
    try:
        write_windows(whole, path, run, OPEN_WINDOWS, top, listed)
        if timing_path:
            write_timing(whole, began, timing_path, run, OPEN_WINDOWS)
    finally:
        whole.unpersist()
