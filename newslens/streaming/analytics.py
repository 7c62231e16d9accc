"""The streaming analytics job: windowed metrics from scraped article messages."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newslens.functions.sentiment import Lexicon
from newslens.functions.times import RUN_WINDOWS, WINDOW_MINUTES
from newslens.operators import metrics as M
from newslens.operators.sentiment import Labeller, labelled, with_sentiment
from newslens.operators.timing import timing_metrics
from newslens.operators.windows import bounded_run
from newslens.operators.words import STREAM_TOP
from newslens.schemas import scraped_message
from newslens.sources.messages import parse_envelope
from newslens.sources.sinks import drop_metrics, stream_id, write_metrics, write_step

# How late a message may be. State is kept for open windows only, this much past them.
LATENESS = "10 minutes"
# The step under which windows that are open at the end are stored.
OPEN_WINDOWS = -1
TRIGGER = f"{WINDOW_MINUTES} minutes"


def scored_stream(messages: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Parsed and labelled articles; a projection, so it keeps no state.

    Ids are text, as the ingest job publishes them; numbers are read as their digits.
    """
    return with_sentiment(parsed_stream(messages), lexicon)


def parsed_stream(messages: DataFrame) -> DataFrame:
    """Parsed articles without labels."""
    return parse_envelope(messages, scraped_message(T.StringType()))


def scored_batch(articles: DataFrame, lexicon: Lexicon | Labeller) -> DataFrame:
    """The articles of one batch with their labels, by a lexicon of any size.

    A label depends on the text alone, so texts are told apart by their digest."""
    if isinstance(lexicon, Lexicon):
        return with_sentiment(articles, lexicon)
    keyed = articles.withColumn("_text", F.sha2("content", 256))
    return labelled(keyed, lexicon, "_text").drop("_text")


def windowed_counts(
    scored: DataFrame,
    start: datetime | Column | None = None,
    windows: int | None = RUN_WINDOWS,
    minutes: int = WINDOW_MINUTES,
    lateness: str = LATENESS,
) -> DataFrame:
    """Counts per event-time window, metric and key.

    One grouping serves all metrics: one scan of the stream, one state store. With a
    ``start``, only the run of ``windows`` windows from there on is counted; messages after
    the run are not counted but still move the watermark, so the last window closes.
    """
    marked = scored.withWatermark("timestamp", lateness)
    if start is not None and windows is not None:
        marked = bounded_run(marked, start, windows=windows, minutes=minutes)
    facts = M.article_facts(marked, by=["timestamp"])
    window = F.window("timestamp", f"{minutes} minutes").alias("window")
    return M.count_facts(facts, [window]).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "metric_name",
        "key",
        "count",
        "total_length",
    )


def metric_writer(
    path: str, top: int = STREAM_TOP, timing_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Callback that stores the windows closed by a micro-batch.

    A closed window arrives whole, so its ranking is exact. Failures are raised: the
    query stops and the batch is tried again, into the same folder.
    """

    def write(counts: DataFrame, epoch_id: int) -> None:
        began = time.time()
        counts.persist()
        try:
            if counts.isEmpty():
                return
            rows = M.report(counts, top, by=["window_start", "window_end"])
            write_metrics(M.metric_rows(rows, "streaming"), path, stream_id(counts), epoch_id)
            if timing_path:
                write_timing(counts, began, timing_path, stream_id(counts), epoch_id)
        finally:
            counts.unpersist()

    return write


def write_timing(counts: DataFrame, began: float, path: str, run: str, epoch_id: int) -> None:
    """How long the counts of a step took, and of how many messages they are."""
    log = counts.where(F.col("metric_name") == M.SENTIMENTS).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("records")
    )
    log = log.select(
        F.lit("streaming").alias("processing_type"),
        F.timestamp_micros(F.lit(int(began * 1_000_000))).alias("start_time"),
        F.timestamp_micros(F.lit(int(time.time() * 1_000_000))).alias("end_time"),
        "records",
    )
    write_step(timing_metrics(log), path, run, epoch_id)


def start_analytics(
    counts: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, str | bool] | None = None,
    top: int = STREAM_TOP,
    timing_path: str | None = None,
) -> StreamingQuery:
    """Start the job. Each window is written once, when the watermark has passed it."""
    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(metric_writer(path, top, timing_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


def finish(
    spark: SparkSession,
    query: StreamingQuery,
    path: str,
    checkpoint: str,
    top: int = STREAM_TOP,
    timing_path: str | None = None,
) -> None:
    """Write the windows that are still open when a stream has ended.

    The counts are read from the state that the ended ``query`` left, and stored as a step of
    its own that the next call replaces. A stream that goes on from the same progress later
    writes those windows itself once they close; call this again after it.
    """
    began = time.time()
    state = spark.read.format("statestore").load(checkpoint)
    fields = [f.name for f in state.schema["value"].dataType.fields]
    key = F.col("key")
    names = [f.name for f in state.schema["key"].dataType.fields]
    counts = state.select(
        key[names[0]]["start"].alias("window_start"),
        key[names[0]]["end"].alias("window_end"),
        key[names[1]].alias("metric_name"),
        key[names[2]].alias("key"),
        F.col("value")[fields[0]].alias("count"),
        F.col("value")[fields[1]].alias("total_length"),
    )
    rows = M.metric_rows(M.report(counts, top, by=["window_start", "window_end"]), "streaming")
    drop_metrics(spark, path, "streaming", str(query.id), OPEN_WINDOWS)
    write_metrics(rows, path, str(query.id), OPEN_WINDOWS)
    if timing_path:
        write_timing(counts, began, timing_path, str(query.id), OPEN_WINDOWS)


def await_windows(query: StreamingQuery, end: datetime, poll: float = 5.0) -> None:
    """Wait until the watermark has passed ``end`` or the query ends, then stop it."""
    while not query.awaitTermination(poll):
        mark = ((query.lastProgress or {}).get("eventTime") or {}).get("watermark")
        if mark and datetime.fromisoformat(mark.replace("Z", "+00:00")) >= end:
            query.processAllAvailable()
            query.stop()


def start_scoring(
    scored: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, str | bool] | None = None,
) -> StreamingQuery:
    """Append labelled articles to a table, exactly once per message."""
    return (
        scored.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
