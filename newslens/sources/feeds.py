"""Landed feeds: RSS files and pages of JSON API responses.

Fetching is the business of whatever lands the files; reading them scales with the
number of files and, for RSS, with the splits inside a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.schemas import API_RESPONSE, FEED_TOPICS, RSS_ITEM

# Links to video pages hold no article, and the feed that has such links.
VIDEO_PATH = "/videos"
VIDEO_SOURCE = "BBC"


def read_rss(spark: SparkSession, path: str, source: str) -> DataFrame:
    """One row per feed entry: source, title, url. A feed without entries gives none."""
    items = spark.read.format("xml").schema(RSS_ITEM).option("rowTag", "item").load(path)
    return items.select(F.lit(source).alias("source"), "title", F.col("link").alias("url"))


def read_api(spark: SparkSession, path: str, source: str, one_per_file: bool = True) -> DataFrame:
    """One row per result of every landed response; responses without results give none.

    Responses landed one per line, many to a file, are split among tasks; a file that
    holds a single response over several lines is read by one.
    """
    responses = spark.read.schema(API_RESPONSE).option("multiLine", one_per_file).json(path)
    return api_results(responses, F.col("response"), source)


def api_results(responses: DataFrame, response: Column, source: str) -> DataFrame:
    return responses.select(F.inline(response["results"])).select(
        F.lit(source).alias("source"),
        F.col("webTitle").alias("title"),
        F.col("webUrl").alias("url"),
    )


def without_videos(feed: DataFrame, source: str | None = None) -> DataFrame:
    """The feed without video links; with ``source``, other sources keep theirs."""
    video = F.col("url").contains(VIDEO_PATH)
    return feed.where(~(video & (F.col("source") == source) if source else video))


def topic_of(source: Column) -> Column:
    """Topic of a source: by the fixed table, else the name in lower case plus _news."""
    known = F.create_map(*[F.lit(x) for pair in FEED_TOPICS.items() for x in pair])
    return F.coalesce(
        F.try_element_at(known, source), F.concat(F.lower(source), F.lit("_news"))
    )
