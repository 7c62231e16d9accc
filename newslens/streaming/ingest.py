"""The streaming ingest job: feed messages to processed articles and scraped messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslens.functions.sentiment import Lexicon
from newslens.plans.ingest import ingest, write_ingested
from newslens.schemas import FEED_MESSAGE
from newslens.sources.messages import decode
from newslens.sources.sinks import stream_id

TRIGGER = "30 seconds"
# Urls of one batch that may be broadcast.
BROADCAST_URLS = 200_000


def of_feed(pages: DataFrame, feed: DataFrame, limit: int = BROADCAST_URLS) -> DataFrame:
    """The pages that a batch of feed records names.

    The urls of a batch are few; up to ``limit`` of them are sent to the tasks that scan the
    pages, so that no markup is moved to find out that nobody asked for it.
    """
    urls = feed.select("url").where("url IS NOT NULL").distinct()
    few = urls.limit(limit + 1).count() <= limit
    return pages.join(F.broadcast(urls) if few else urls, "url", "left_semi")


def start_ingest(
    messages: DataFrame,
    pages: str,
    lexicon: Lexicon,
    folder: str,
    checkpoint: str,
    trigger: dict[str, str | bool] | None = None,
    position: str = "key",
    publish: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Join each batch of feed messages with the crawled pages and store the outcome.

    ``pages`` is the path of the crawled pages, read anew for every batch, so that pages
    crawled after the start are found. Writes ``raw``, ``processed``, ``rejected`` and the
    scraped topic under ``folder``, one folder per stream and epoch, so a batch that is
    tried again replaces its own rows. ``position`` tells two equal records apart; in files
    that is the key of a message, on a broker partition and offset.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        feed = decode(batch, FEED_MESSAGE, position).persist()
        try:
            crawled = batch.sparkSession.read.parquet(pages).select("url", "html")
            out = ingest(feed, of_feed(crawled, feed), lexicon, position, extract_first=False)
            part = f"run={stream_id(batch)}/epoch={epoch_id}"
            write_ingested(out, lexicon, folder, part=part, publish=publish)
        finally:
            feed.unpersist()

    return (
        messages.where(F.col("value").isNotNull())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
