"""Article metrics, metric rows and what is read back from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.functions.text import is_long_word, lower_words, raw_words
from newslens.functions.times import RUN_WINDOWS, plus_windows
from newslens.operators.words import top_words_per

# Names of the stored metrics; batch rows carry the suffix.
WORDS = "word_counts"
SENTIMENTS = "sentiment_distribution"
SOURCES = "source_statistics"
BATCH_SUFFIX = "_batch"

WORD_ITEMS = "array<struct<word:string,count:bigint>>"
SENTIMENT_ITEMS = "array<struct<sentiment:string,count:bigint>>"
SOURCE_ITEMS = "array<struct<source:string,count:bigint,total_length:bigint>>"


def article_count(articles: DataFrame) -> DataFrame:
    return articles.agg(F.count(F.lit(1)).alias("article_count"))


def sentiment_distribution(articles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return articles.groupBy(*by, "sentiment").agg(F.count(F.lit(1)).alias("count"))


def source_statistics(articles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return articles.groupBy(*by, "source").agg(
        F.count(F.lit(1)).alias("article_count"),
        F.sum(F.length("content").cast("bigint")).alias("total_length"),
    )


def with_share(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``share``, the percentage of the total with one decimal; 0 for a total of 0.

    Runs over the counts, a handful of rows, never over the articles.
    """
    total = F.sum("count").over(Window.partitionBy(*by))
    share = F.when(total > 0, F.round(F.lit(100.0) * F.col("count") / total, 1)).otherwise(0.0)
    return counts.withColumn("share", share)


def with_average_length(stats: DataFrame) -> DataFrame:
    """Add ``avg_length``, rounded to whole characters; 0 where there are no articles."""
    mean = F.col("total_length").cast("double") / F.col("article_count")
    return stats.withColumn(
        "avg_length", F.when(F.col("article_count") > 0, F.round(mean, 0)).otherwise(0.0)
    )


def sentiment_and_sources(articles: DataFrame) -> DataFrame:
    """Both groupings from one scan: (metric_name, key, count, total_length)."""
    sets = articles.select("source", "sentiment", F.length("content").alias("chars")).groupingSets(
        [["source"], ["sentiment"]], "source", "sentiment"
    )
    by_source = F.grouping("sentiment") == 1
    return sets.agg(
        F.when(by_source, SOURCES).otherwise(SENTIMENTS).alias("metric_name"),
        F.when(by_source, F.col("source")).otherwise(F.col("sentiment")).alias("key"),
        F.count(F.lit(1)).alias("count"),
        F.when(by_source, F.sum(F.col("chars").cast("bigint"))).alias("total_length"),
    ).select("metric_name", "key", "count", "total_length")


def article_facts(articles: DataFrame, by: Sequence[str] = (), batch: bool = False) -> DataFrame:
    """Everything the report counts, in long form, from one pass over the articles.

    One row per word, one for the sentiment and one for the source of each article, as
    (metric_name, key, chars). One grouping then serves all three metrics, which keeps a
    stream to a single scan and a single state store.
    """
    suffix = BATCH_SUFFIX if batch else ""
    content = F.col("content")

    def fact(name: str, key: Column, chars: Column) -> Column:
        return F.struct(
            F.lit(name + suffix).alias("metric_name"),
            key.alias("key"),
            chars.cast("bigint").alias("chars"),
        )

    nothing = F.lit(None)
    if batch:
        words = F.filter(raw_words(content), lambda w: w != "")
    else:
        words = F.filter(lower_words(content), is_long_word)
    facts = F.concat(
        F.array(
            fact(SENTIMENTS, F.col("sentiment"), nothing),
            fact(SOURCES, F.col("source"), F.length(content)),
        ),
        F.coalesce(
            F.transform(words, lambda w: fact(WORDS, w, nothing)),
            F.expr("array()").cast("array<struct<metric_name:string,key:string,chars:bigint>>"),
        ),
    )
    return articles.select(*by, F.inline(facts))


def count_facts(facts: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    return facts.groupBy(*by, "metric_name", "key").agg(
        F.count(F.lit(1)).alias("count"), F.sum("chars").alias("total_length")
    )


def report(counts: DataFrame, top: int, by: Sequence[str] = ()) -> DataFrame:
    """Counted facts with the words cut to the ``top`` of each group."""
    is_word = F.col("metric_name").startswith(WORDS)
    words = top_words_per(
        counts.where(is_word).withColumnRenamed("key", "word"), [*by, "metric_name"], top
    )
    columns = [*by, "metric_name", "key", "count", "total_length"]
    return (
        words.withColumnRenamed("word", "key")
        .select(*columns)
        .unionByName(counts.where(~is_word).select(*columns))
    )


def metric_rows(rows: DataFrame, processing_type: str, parts: int = 1) -> DataFrame:
    """Report rows with window bounds as stored metric rows, one JSON array each.

    Words arrive already cut to the ranking. Sources are as many as there are
    publishers; ``parts`` above 1 spreads them over that many rows per window, and
    every reader sums over rows, so the answers stay the same.
    """
    window = ["window_start", "window_end", "metric_name"]
    part = F.when(
        F.col("metric_name").startswith(SOURCES), F.pmod(F.hash("key"), F.lit(parts))
    ).otherwise(0)
    # Words sort by count, the rest by name; the leading field decides.
    is_word = F.col("metric_name").startswith(WORDS)
    item = F.struct(
        F.when(is_word, -F.col("count")).otherwise(0).alias("order"),
        F.col("key"),
        F.col("count"),
        F.col("total_length"),
    )

    def as_json(*fields: str) -> Column:
        return F.to_json(
            F.transform(
                F.col("items"),
                lambda x: F.struct(*[x[f.split(":")[0]].alias(f.split(":")[1]) for f in fields]),
            )
        )

    name = F.col("metric_name")
    return (
        rows.groupBy(*window, part.alias("part"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select(
            F.md5(
                F.concat_ws(
                    "|",
                    F.unix_micros("window_start"),
                    "metric_name",
                    F.lit(processing_type),
                    "part",
                )
            ).alias("id"),
            "window_start",
            "window_end",
            "metric_name",
            F.when(name.startswith(WORDS), as_json("key:word", "count:count"))
            .when(name.startswith(SENTIMENTS), as_json("key:sentiment", "count:count"))
            .otherwise(as_json("key:source", "count:count", "total_length:total_length"))
            .alias("metric_value"),
            F.lit(processing_type).alias("processing_type"),
        )
    )


def latest(results: DataFrame) -> DataFrame:
    """One row per run, window, metric and part: what a later step wrote replaces what an
    earlier one did. Windows that were stored while open have the lowest step of all, so the
    row of the closed window stands in for them. Results without steps are as they are."""
    if not {"run", "epoch_id"} <= set(results.columns):
        return results
    rest = [c for c in results.columns if c not in ("run", "id")]
    newest = F.max_by(F.struct(*rest), "epoch_id").alias("row")
    return results.groupBy("run", "id").agg(newest).select("id", "run", "row.*").select(*results.columns)


def recent_metrics(results: DataFrame, processing_type: str = "streaming", n: int = 3) -> DataFrame:
    """The last ``n`` stored rows of one processing type."""
    return (
        results.where(F.col("processing_type") == processing_type)
        .select("metric_name", "metric_value", "window_start", "window_end")
        .orderBy(F.desc("window_start"), F.asc("metric_name"))
        .limit(n)
    )


def of_run(
    results: DataFrame, start: datetime | Column, windows: int = RUN_WINDOWS
) -> DataFrame:
    """The stored rows of one run of ``windows`` windows from ``start`` on."""
    begin = F.lit(start)
    return results.where(
        (F.col("window_start") >= begin) & (F.col("window_end") <= plus_windows(begin, windows))
    )


def metric_items(results: DataFrame, metric_name: str, items: str, by: Sequence[str] = ()) -> DataFrame:
    """The JSON arrays of one stored metric as rows."""
    return results.where(F.col("metric_name") == metric_name).select(
        *by, F.inline(F.from_json("metric_value", items))
    )


def rollup_sentiment(results: DataFrame, suffix: str = "") -> DataFrame:
    items = metric_items(results, SENTIMENTS + suffix, SENTIMENT_ITEMS)
    return items.groupBy("sentiment").agg(F.sum("count").alias("count"))


def rollup_words(results: DataFrame, suffix: str = "") -> DataFrame:
    """Sum of the stored rankings per word. A word below the cut in a window is not in
    them; use the full counts where the exact overall ranking is wanted."""
    items = metric_items(results, WORDS + suffix, WORD_ITEMS)
    return items.groupBy("word").agg(F.sum("count").alias("count"))


def rollup_sources(results: DataFrame, suffix: str = "") -> DataFrame:
    items = metric_items(results, SOURCES + suffix, SOURCE_ITEMS)
    return items.groupBy("source").agg(
        F.sum("count").alias("article_count"), F.sum("total_length").alias("total_length")
    )
