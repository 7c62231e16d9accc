"""Row layouts of the messages and tables, and the rules their columns must keep."""

from __future__ import annotations

from pyspark.sql import types as T

# Table layouts, message fields and names other programs rely on.

FEED_MESSAGE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)


def scraped_message(raw_id: T.DataType | None = None) -> T.StructType:
    """Layout of a scraped article message.

    ``raw_id`` is a number in messages written by other programs; the ingest job of
    this package writes text ids.
    """
    return T.StructType(
        [
            T.StructField("raw_id", raw_id or T.LongType()),
            T.StructField("source", T.StringType()),
            T.StructField("title", T.StringType()),
            T.StructField("content", T.StringType()),
        ]
    )


SCRAPED_MESSAGE = scraped_message()

API_RESPONSE = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField(
                        "results",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("webTitle", T.StringType()),
                                    T.StructField("webUrl", T.StringType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

RSS_ITEM = T.StructType(
    [T.StructField("title", T.StringType()), T.StructField("link", T.StringType())]
)

RAW_ARTICLES = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("url", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

PROCESSED_ARTICLES = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("raw_article_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("content", T.StringType(), False),
        T.StructField("sentiment", T.StringType(), False),
        T.StructField("word_count", T.IntegerType(), False),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

ANALYTICS_RESULTS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("window_start", T.TimestampType(), False),
        T.StructField("window_end", T.TimestampType(), False),
        T.StructField("metric_name", T.StringType(), False),
        T.StructField("metric_value", T.StringType(), False),
        T.StructField("processing_type", T.StringType(), False),
        T.StructField("created_at", T.TimestampType()),
    ]
)

TIMING_METRICS = T.StructType(
    [
        T.StructField("processing_type", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("processing_duration_seconds", T.DoubleType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_per_second", T.DoubleType()),
    ]
)

TABLES = {
    "raw_articles": RAW_ARTICLES,
    "processed_articles": PROCESSED_ARTICLES,
    "analytics_results": ANALYTICS_RESULTS,
}

PROCESSING_TYPES = ("streaming", "batch")

SENTIMENTS = ("positive", "negative", "neutral")

FEED_TOPICS = {"BBC": "bbc_news", "Guardian": "guardian_news", "Reuters": "reuters_news"}

SCRAPED_TOPIC = "scraped_articles"
