"""The batch analytics job over the full history, and windowed reports over a table."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.times import WINDOW_MINUTES
from newslens.operators import metrics as M
from newslens.operators import words as W
from newslens.operators.timing import timing_metrics
from newslens.operators.windows import with_window
from newslens.schemas import TIMING_METRICS
from newslens.sources.sinks import read_metrics, write_metrics, write_step


def batch_words(scored: DataFrame) -> DataFrame:
    """Counts of all words in the layout of the report, none cut."""
    return W.count_words(W.all_words(scored)).select(
        F.lit(M.WORDS + M.BATCH_SUFFIX).alias("metric_name"),
        F.col("word").alias("key"),
        "count",
        F.lit(None).cast("bigint").alias("total_length"),
    )


def batch_groups(scored: DataFrame) -> DataFrame:
    """Counts of sentiments and sources in the layout of the report."""
    groups = M.sentiment_and_sources(scored)
    return groups.withColumn("metric_name", F.concat("metric_name", F.lit(M.BATCH_SUFFIX)))


def batch_report(scored: DataFrame, top: int = W.BATCH_TOP) -> DataFrame:
    """All batch metrics in long form: (metric_name, key, count, total_length).

    Words are counted apart from the rest: a second scan of the text costs a third of what it
    costs to carry the name of a metric with every word through one common grouping.
    """
    words = batch_words(scored).orderBy(F.desc("count"), F.asc("key")).limit(top)
    return words.unionByName(batch_groups(scored))


def batch_metric_rows(scored: DataFrame, at: Column, top: int = W.BATCH_TOP) -> DataFrame:
    """The batch report as stored rows; both window bounds are the time of the run."""
    report = batch_report(scored, top)
    stamped = report.withColumn("window_start", at).withColumn("window_end", at)
    return M.metric_rows(stamped, "batch")


def windowed_report(
    scored: DataFrame, top: int = W.STREAM_TOP, minutes: int = WINDOW_MINUTES
) -> DataFrame:
    """All stream metrics per event-time window, over a table, in long form."""
    window = ["window_start", "window_end"]
    framed = with_window(scored, minutes=minutes)
    counts = W.count_words(W.long_words(framed, window), window)
    words = W.top_words_per(counts, window, top).select(
        *window,
        F.lit(M.WORDS).alias("metric_name"),
        F.col("word").alias("key"),
        "count",
        F.lit(None).cast("bigint").alias("total_length"),
    )
    rest = framed.select(*window, "source", "sentiment", F.length("content").alias("chars"))
    by_source = F.grouping("sentiment") == 1
    groups = rest.groupingSets(
        [[*window, "source"], [*window, "sentiment"]], *window, "source", "sentiment"
    ).agg(
        F.when(by_source, M.SOURCES).otherwise(M.SENTIMENTS).alias("metric_name"),
        F.when(by_source, F.col("source")).otherwise(F.col("sentiment")).alias("key"),
        F.count(F.lit(1)).alias("count"),
        F.when(by_source, F.sum(F.col("chars").cast("bigint"))).alias("total_length"),
    )
    return words.unionByName(groups.select(*words.columns))


def windowed_metric_rows(scored: DataFrame, top: int = W.STREAM_TOP) -> DataFrame:
    """The windowed report as stored rows, as the streaming job would have left them."""
    return M.metric_rows(windowed_report(scored, top), "streaming")


def run_batch(scored: DataFrame, metrics_path: str, timing_path: str) -> DataFrame:
    """Run the batch job: write its metric rows and one timing row, return the latter.

    The number of records comes out of the written sentiment counts, so the articles
    are not read again to count them.
    """
    spark = scored.sparkSession
    start = time.time()
    now = F.lit(datetime.fromtimestamp(start, timezone.utc))
    run = f"batch-{uuid.uuid4().hex}"
    write_metrics(batch_metric_rows(scored, now), metrics_path, run)
    written = read_metrics(spark, metrics_path).where(F.col("run") == run)
    items = M.metric_items(written, M.SENTIMENTS + M.BATCH_SUFFIX, M.SENTIMENT_ITEMS)
    log = items.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("records")).select(
        F.lit("batch").alias("processing_type"),
        now.alias("start_time"),
        F.timestamp_micros(F.lit(int(time.time() * 1_000_000))).alias("end_time"),
        "records",
    )
    row = timing_metrics(log)
    write_step(row.select(*TIMING_METRICS.names), timing_path, run)
    return row
