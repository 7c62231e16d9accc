"""Messages: records as JSON values on named topics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.schemas import FEED_MESSAGE, SCRAPED_MESSAGE
from newslens.sources.feeds import topic_of

MESSAGE_FILE = "topic string, value string, timestamp timestamp, key string"


def encode(records: DataFrame, fields: T.StructType, *keep: str) -> DataFrame:
    """Add ``value``, the named fields as one JSON object, next to ``keep``."""
    return records.select(*keep, F.to_json(F.struct(*fields.names)).alias("value"))


def decode(messages: DataFrame, fields: T.StructType, *keep: str) -> DataFrame:
    """The fields of each JSON value. Values that do not parse keep their row, as nulls."""
    text = F.col("value").cast("string")
    return messages.select(F.from_json(text, fields).alias("data"), *keep).select("data.*", *keep)


def parse_envelope(messages: DataFrame, fields: T.StructType = SCRAPED_MESSAGE) -> DataFrame:
    """Scraped articles with the time the broker gave each message."""
    return decode(messages, fields, "timestamp")


def route(feed: DataFrame, *keep: str) -> DataFrame:
    """Feed records as (topic, value)."""
    return encode(feed.withColumn("topic", topic_of(F.col("source"))), FEED_MESSAGE, "topic", *keep)


def merge(*topics: DataFrame) -> DataFrame:
    """Several topics as one stream of messages. Nothing is removed or reordered."""
    return reduce(DataFrame.unionByName, topics)


def write_topics(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as files, one folder per topic, each with a key that no other one has."""
    messages.withColumn("key", F.expr("uuid()")).write.mode(mode).partitionBy("topic").json(path)


def read_topics(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """Landed messages of the named topics, of all topics when none is named."""
    messages = spark.read.schema(MESSAGE_FILE).json(path)
    return messages.where(F.col("topic").isin(*names)) if names else messages


def stream_topics(
    spark: SparkSession, path: str, *names: str, files_per_batch: int | None = None
) -> DataFrame:
    """As ``read_topics``, as a stream over files that keep landing."""
    reader = spark.readStream.schema(MESSAGE_FILE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    messages = reader.json(path)
    return messages.where(F.col("topic").isin(*names)) if names else messages
