"""Feed records that wait for their pages, as a join of two streams.

The pages land as a stream of their own. A record meets a page of its url that is crawled
within a span around the record's own time; one whose page has not come by the end of the
span is given up. Both sides are kept as state for that span only, which the two watermarks
end, and pages are extracted before they are kept, so the state holds articles, not markup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslens.functions.sentiment import Lexicon
from newslens.operators import extraction
from newslens.operators.quality import conform
from newslens.plans.ingest import outputs, raw_article_id, write_ingested
from newslens.schemas import FEED_MESSAGE, RAW_ARTICLES
from newslens.sources.messages import decode
from newslens.sources.sinks import stream_id

#: How long a record waits for its page, and how old a page may be when its record comes.
WAIT, LOOK_BACK = "1 hour", "1 day"
#: How late a record or a page may land behind its own time.
LATENESS = "10 minutes"


def feed_records(messages: DataFrame, position: str = "key", lateness: str | None = LATENESS) -> DataFrame:
    """Feed messages as records with an id and the time they were sent at; a stream with a watermark.

    ``lateness`` is None where the messages have one already."""
    feed = decode(messages.where(F.col("value").isNotNull()), FEED_MESSAGE, position, "timestamp")
    return (feed.withWatermark("timestamp", lateness) if lateness else feed).select(
        raw_article_id(F.col("source"), F.col("url"), F.col(position)).alias("id"), "source", "title", "url", "timestamp"
    )


def distinct_records(records: DataFrame) -> DataFrame:
    """One record per source and url among those that lie within the watermark of each other.

    The first one to arrive stays, whichever batch repeats it, also after a restart. State is
    one small row per record of that span. Records without a url are told apart by their id.
    """
    key = F.struct(F.col("source"), F.coalesce("url", "id"))
    return records.withColumn("_same", key).dropDuplicatesWithinWatermark(["_same"]).drop("_same")


def distinct_messages(messages: DataFrame, position: str = "key", within: str = LATENESS) -> DataFrame:
    """As ``distinct_records``, over messages that are not read yet, whose columns stay as they are."""
    record = F.from_json(F.col("value").cast("string"), FEED_MESSAGE)
    same = F.struct(record["source"].alias("source"), F.coalesce(record["url"], F.col(position)).alias("url"))
    marked = messages.withWatermark("timestamp", within).withColumn("_same", same)
    return marked.dropDuplicatesWithinWatermark(["_same"]).drop("_same")


def crawled_pages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Pages as they land: (url, html, crawled_at). Without a ``crawled_at`` in the files, the
    time at which a file was written stands for it."""
    layout = spark.read.parquet(path).schema
    reader = spark.readStream.schema(layout)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.parquet(path)
    if "crawled_at" in layout.names:
        return pages.select("url", "html", "crawled_at")
    return pages.select("url", "html", F.col("_metadata.file_modification_time").alias("crawled_at"))


def span(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def with_pages(
    records: DataFrame,
    pages: DataFrame,
    wait: str = WAIT,
    look_back: str = LOOK_BACK,
    lateness: str = LATENESS,
) -> DataFrame:
    """Records with the article of their page, one row each: (id, source, title, url, content, timestamp).

    A record whose page never comes is passed on without content once its time is over. Of
    several pages of one url within the span the first to be found counts.
    """
    found = extraction.articles(pages).select(
        F.col("url").alias("page_url"), F.col("title").alias("page_title"), "content", "crawled_at"
    )
    found = found.withWatermark("crawled_at", lateness)
    near = (
        (F.col("url") == F.col("page_url"))
        & (F.col("crawled_at") >= F.col("timestamp") - span(look_back))
        & (F.col("crawled_at") <= F.col("timestamp") + span(wait))
    )
    met = records.join(found, near, "left_outer").select(
        "id", "source", "title", "url", "page_title", "content", "timestamp"
    )
    return met.dropDuplicatesWithinWatermark(["id"])


def start_waiting_ingest(
    records: DataFrame,
    pages: DataFrame,
    lexicon: Lexicon,
    folder: str,
    checkpoint: str,
    trigger: dict[str, str | bool] | None = None,
    wait: str = WAIT,
    look_back: str = LOOK_BACK,
    lateness: str = LATENESS,
    publish: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """As ``start_ingest``, with records that wait for their pages.

    A record is stored, as processed or rejected, when its page has come or its time is
    over, in the folder of the batch that finds out; a batch that is tried again replaces
    its own rows.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        raw = conform(batch.select("id", "source", "title", "url"), RAW_ARTICLES)
        extracted = batch.select(
            F.col("id").alias("raw_article_id"), "source", "url", F.col("page_title").alias("title"), "content"
        )
        part = f"run={stream_id(batch)}/epoch={epoch_id}"
        batch.persist()
        try:
            if batch.isEmpty():
                return
            write_ingested(outputs(raw, extracted, lexicon), lexicon, folder, part=part, publish=publish)
        finally:
            batch.unpersist()

    return (
        with_pages(records, pages, wait, look_back, lateness)
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
