"""Word frequencies and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions.text import is_long_word, is_stop_word, lower_words, raw_words

# Length of the streaming and of the batch ranking.
STREAM_TOP = 10
BATCH_TOP = 5


def long_words(articles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per word as the stream counts them: lower case, long, letters only."""
    words = articles.select(*by, F.explode(lower_words(F.col("content"))).alias("word"))
    return words.where(is_long_word(F.col("word")))


def all_words(articles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per word as the batch job counts them: case kept, none dropped but ''."""
    words = articles.select(*by, F.explode(raw_words(F.col("content"))).alias("word"))
    return words.where(F.col("word") != "")


def content_words(articles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per word in lower case, stop words left out."""
    words = articles.select(*by, F.explode(raw_words(F.col("content"))).alias("word"))
    lower = words.select(*by, F.lower("word").alias("word"))
    return lower.where((F.col("word") != "") & ~is_stop_word(F.col("word")))


def count_words(words: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count per word. Each task sums its own words first, so a frequent word costs the
    shuffle one row per task."""
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words; equal counts in alphabetical order."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(k)


def top_words_per(counts: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent words of each group, with ``rank``.

    Spark keeps only ``k`` rows per group and task before it shuffles by group, so one
    group holding most of the words is still ranked by all tasks together.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("count"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
