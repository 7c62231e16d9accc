"""The batch report over a table that grows, without reading what was read before.

Each run takes the files that came since the last one as a slice, counts them, and keeps the
counts: all words, sentiments and sources. The report is the sum over slices, so it equals
that of a run over everything. The listing starts at the newest time of the files already
taken (the high-water mark), less some slack for clocks that differ; within the slack files
are told apart by name. Files are taken as written once and for all, as all jobs here write
them.

A slice counts once its commit is there, a file of its own that is created as the last step
and in one go. A run that fails before leaves nothing that is read; the next run takes its
number and replaces its rows. Two runs at once cannot both commit. Every ``MERGED`` slices
are added up to one, so neither files nor rows pile up.

Folders of the store: ``counts`` and ``files`` by slice, and ``commits``, whose file names
are ``<slice>-<first slice that still counts>``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.operators import metrics as M
from newslens.operators import words as W
from newslens.operators.timing import timing_metrics
from newslens.plans.batch_report import batch_groups, batch_words
from newslens.schemas import TIMING_METRICS
from newslens.sources.sinks import write_metrics, write_step

COUNTS = "metric_name string, key string, count bigint, total_length bigint, slice bigint"
FILES = "path string, modified timestamp, slice bigint"
#: Files may be up to this much older than the newest one taken so far.
SLACK = timedelta(hours=1)
#: Slices that are added up to one.
MERGED = 32


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def last_commit(spark: SparkSession, store: str) -> tuple[int, int] | None:
    """The last committed slice and the first one that still counts."""
    place, files = _folder(spark, f"{store}/commits")
    if not files.exists(place):
        return None
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return max((tuple(int(n) for n in name.split("-")) for name in names if name[:1].isdigit()), default=None)


def commit(spark: SparkSession, store: str, number: int, first: int) -> None:
    taken = last_commit(spark, store)
    place, files = _folder(spark, f"{store}/commits/{number}-{first}")
    if taken and taken[0] >= number or not files.createNewFile(place):
        raise RuntimeError(f"another run has committed slice {number}")


def committed(spark: SparkSession, store: str, name: str, layout: str) -> DataFrame:
    """The rows of one of the store's tables that count; reads the folders of those slices only."""
    last = last_commit(spark, store)
    if last is None:
        return spark.createDataFrame([], layout)
    number, first = last
    low = 0 if name == "files" else first
    table = spark.read.schema(layout).parquet(f"{store}/{name}")
    return table.where(F.col("slice").between(low, number))


def _write(rows: DataFrame, store: str, name: str, number: int) -> None:
    (
        rows.withColumn("slice", F.lit(number).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("slice").parquet(f"{store}/{name}")
    )


def new_files(spark: SparkSession, articles: str, store: str) -> DataFrame:
    """(path, modified) of the table's files that no committed slice has taken."""
    known = committed(spark, store, "files", FILES)
    mark = known.agg(F.max(F.unix_micros("modified")).alias("m")).first()["m"]
    reader = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    )
    if mark is not None:
        since = datetime.fromtimestamp(mark / 1e6, timezone.utc) - SLACK
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
        known = known.where(F.unix_micros("modified") >= mark - int(SLACK.total_seconds() * 1e6) - 1_000_000)
    listed = reader.load(articles).select("path", F.col("modificationTime").alias("modified"))
    return listed.join(known.select("path"), "path", "left_anti")


def counts_of(scored: DataFrame) -> DataFrame:
    return batch_words(scored).unionByName(batch_groups(scored))


def added(counts: DataFrame) -> DataFrame:
    return counts.groupBy("metric_name", "key").agg(
        F.sum("count").alias("count"), F.sum("total_length").alias("total_length")
    )


def take_slice(
    spark: SparkSession, articles: str, store: str, score: Callable[[DataFrame], DataFrame]
) -> tuple[int | None, list[str]]:
    """Count the new files as one slice; its number (None if there were none) and its files."""
    fresh = new_files(spark, articles, store).collect()
    if not fresh:
        return None, []
    last = last_commit(spark, store)
    number, first = (last[0] + 1, last[1]) if last else (0, 0)
    paths = sorted(r["path"] for r in fresh)
    _write(counts_of(score(spark.read.parquet(*paths))), store, "counts", number)
    _write(spark.createDataFrame(fresh, "path string, modified timestamp"), store, "files", number)
    commit(spark, store, number, first)
    return number, paths


def merge_slices(spark: SparkSession, store: str, limit: int = MERGED) -> bool:
    """Add up the slices that count to one, if there are ``limit`` of them or more."""
    last = last_commit(spark, store)
    if last is None or last[0] - last[1] + 1 < limit:
        return False
    number = last[0] + 1
    _write(added(committed(spark, store, "counts", COUNTS).drop("slice")), store, "counts", number)
    commit(spark, store, number, number)
    return True


def stored_report(spark: SparkSession, store: str, top: int = W.BATCH_TOP) -> DataFrame:
    """The batch report of everything the store has counted."""
    return M.report(added(committed(spark, store, "counts", COUNTS).drop("slice")), top)


def run_incremental(
    spark: SparkSession,
    articles: str,
    store: str,
    score: Callable[[DataFrame], DataFrame],
    metrics_path: str,
    timing_path: str,
    top: int = W.BATCH_TOP,
) -> DataFrame:
    """Take a slice, write the metric rows of all slices and one timing row; return the latter.

    ``score`` adds sentiments to articles. The timing row counts the records of the slice.
    """
    began = time.time()
    now = F.lit(datetime.fromtimestamp(began, timezone.utc))
    number, _ = take_slice(spark, articles, store, score)
    run = f"batch-{uuid.uuid4().hex}"
    report = stored_report(spark, store, top).withColumn("window_start", now).withColumn("window_end", now)
    write_metrics(M.metric_rows(report, "batch"), metrics_path, run)
    moods = F.col("metric_name") == M.SENTIMENTS + M.BATCH_SUFFIX
    mine = committed(spark, store, "counts", COUNTS).where(moods & (F.col("slice") == F.lit(number)))
    log = mine.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("records")).select(
        F.lit("batch").alias("processing_type"),
        now.alias("start_time"),
        F.timestamp_micros(F.lit(int(time.time() * 1_000_000))).alias("end_time"),
        "records",
    )
    row = timing_metrics(log)
    write_step(row.select(*TIMING_METRICS.names), timing_path, run)
    merge_slices(spark, store)
    return row
