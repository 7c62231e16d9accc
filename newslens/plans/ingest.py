"""From feed records and crawled pages to processed articles and messages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions.sentiment import Lexicon
from newslens.functions.text import word_count
from newslens.operators import extraction
from newslens.operators.sentiment import Labeller, labelled
from newslens.operators.quality import conform
from newslens.schemas import RAW_ARTICLES, SCRAPED_TOPIC, scraped_message
from newslens.sources.messages import encode


def raw_article_id(source: Column, url: Column, position: Column) -> Column:
    """Id from the record and its place in the feed: needs no counter, and a record that
    is polled again gets an id of its own."""
    return F.md5(F.concat_ws("|", source, url, position.cast("string")))


def raw_articles(feed: DataFrame, position: str, dedupe: bool = False) -> DataFrame:
    """Feed records with their id. ``dedupe`` keeps one record per url."""
    if dedupe:
        feed = feed.groupBy("url").agg(
            F.min_by(F.struct("source", "title", position), position).alias("r")
        ).select("r.*", "url")
    return feed.select(
        raw_article_id(F.col("source"), F.col("url"), F.col(position)).alias("id"),
        "source",
        "title",
        "url",
    )


@dataclass(frozen=True)
class Ingested:
    """Outputs of the ingest job, all lazy over the same plan."""

    raw: DataFrame
    extracted: DataFrame
    processed: DataFrame
    rejected: DataFrame
    messages: DataFrame

    def from_extracted(self, extracted: DataFrame, lexicon: Lexicon) -> Ingested:
        """The same outputs over a stored ``extracted`` table: pages are extracted once
        for all of them, and a lost executor costs no second extraction."""
        return outputs(self.raw, extracted, lexicon)


def ingest(
    feed: DataFrame,
    pages: DataFrame,
    lexicon: Lexicon,
    position: str,
    extract_first: bool = True,
) -> Ingested:
    """Extract the article of every feed record.

    With ``extract_first`` pages are extracted where they are scanned, so the join by url
    moves article texts and not markup: right when most pages are wanted. Without, only
    the pages that a small feed names are extracted. A record whose page is missing or
    holds no article is rejected.
    """
    raw = raw_articles(feed, position)
    records = raw.select(F.col("id").alias("raw_article_id"), "source", "url")
    crawled = pages.select("url", "html")
    if extract_first:
        extracted = records.join(extraction.articles(crawled), "url", "left")
    else:
        extracted = extraction.articles(records.join(crawled, "url", "left"))
    return outputs(raw, extracted, lexicon)


def write_ingested(
    out: Ingested,
    lexicon: Lexicon,
    folder: str,
    part: str = "",
    publish: Callable[[DataFrame], None] | None = None,
) -> None:
    """Write all outputs under ``folder``: the extracted articles first, the others from
    them. With ``part`` they go to a folder of that name, replacing an earlier try.

    Tables get the time they are written at. Messages go to ``publish`` (a broker), or to
    files of the topic under ``folder/topics``, which the analytics job reads as they are.
    """
    spark = out.raw.sparkSession
    topics = f"{folder}/topics/topic={SCRAPED_TOPIC}/{part.replace('=', '-').replace('/', '-')}"
    part = f"/{part}" if part else ""
    extracted = f"{folder}/extracted{part}"
    out.extracted.write.mode("overwrite").parquet(extracted)
    done = out.from_extracted(spark.read.schema(out.extracted.schema).parquet(extracted), lexicon)
    now = F.current_timestamp()
    for name, table in (
        ("raw", conform(done.raw.withColumn("received_at", now), RAW_ARTICLES)),
        ("processed", done.processed.withColumn("processed_at", now)),
        ("rejected", done.rejected),
    ):
        table.write.mode("overwrite").parquet(f"{folder}/{name}{part}")
    if publish:
        publish(done.messages)
    else:
        done.messages.drop("topic").withColumn("timestamp", now).write.mode("overwrite").json(topics)


def outputs(raw: DataFrame, extracted: DataFrame, lexicon: Lexicon) -> Ingested:
    processed = finish(extraction.accepted(extracted), lexicon)
    return Ingested(
        raw=raw,
        extracted=extracted,
        processed=processed,
        rejected=extraction.rejected(extracted).select("raw_article_id", "source", "url"),
        messages=scraped_messages(processed),
    )


def finish(accepted: DataFrame, lexicon: Lexicon | Labeller) -> DataFrame:
    """Accepted articles as processed ones: id, sentiment and word count added."""
    return labelled(accepted, lexicon, "raw_article_id").select(
        F.md5(F.concat_ws("|", F.lit("processed"), "raw_article_id")).alias("id"),
        "raw_article_id",
        "source",
        "title",
        "content",
        "sentiment",
        word_count(F.col("content")).alias("word_count"),
    )


def scraped_messages(processed: DataFrame) -> DataFrame:
    """Processed articles as messages on the scraped topic."""
    fields = scraped_message(T.StringType())
    return encode(
        processed.withColumn("raw_id", F.col("raw_article_id")).withColumn(
            "topic", F.lit(SCRAPED_TOPIC)
        ),
        fields,
        "topic",
    )
