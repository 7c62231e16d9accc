"""Summaries of word counts that can be merged, and exact rankings from them.

A summary of a window lists its most frequent words with their counts and an ``error``: the
count of the most frequent word it leaves out. Over many windows a word then has a lower
bound, the sum of what is listed, and an upper one, which adds the errors of the windows that
do not list it. Most words are decided by their bounds; only the few that are not have to be
counted, so an exact ranking of all windows needs neither their texts nor all their words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.operators.words import top_words, top_words_per

# Fixed value: name of the stored metric.
SUMMARY = "word_summary"
#: Words that a summary lists.
LISTED = 200
#: Undecided words that may be sent to all tasks.
BROADCAST_WORDS = 1_000_000

LAYOUT = "struct<words:array<struct<word:string,count:bigint>>,error:bigint>"


def summarise(counts: DataFrame, by: Sequence[str] = (), size: int = LISTED) -> DataFrame:
    """(by, words, error) from (by, word, count) with each word once per group.

    Only ``size`` + 1 rows per group and task are shuffled, so a group with most of the words
    is summarised by all tasks together.
    """
    ranked = top_words_per(counts, by, size + 1)
    item = F.struct("rank", "word", "count")
    listed = F.sort_array(F.collect_list(F.when(F.col("rank") <= size, item)))
    return ranked.groupBy(*by).agg(
        F.transform(listed, lambda x: F.struct(x["word"].alias("word"), x["count"].alias("count"))).alias("words"),
        F.coalesce(F.max(F.when(F.col("rank") > size, F.col("count"))), F.lit(0)).alias("error"),
    )


def summary_rows(summaries: DataFrame, processing_type: str) -> DataFrame:
    """Summaries of windows as stored metric rows."""
    name = F.concat_ws("|", F.unix_micros("window_start"), F.lit(SUMMARY), F.lit(processing_type), F.lit("0"))
    return summaries.select(
        F.md5(name).alias("id"),
        "window_start",
        "window_end",
        F.lit(SUMMARY).alias("metric_name"),
        F.to_json(F.struct("words", "error")).alias("metric_value"),
        F.lit(processing_type).alias("processing_type"),
    )


def stored_summaries(results: DataFrame) -> DataFrame:
    """(words, error) of the stored summaries."""
    kept = results.where(F.col("metric_name") == SUMMARY)
    return kept.select(F.from_json("metric_value", LAYOUT).alias("s")).select("s.words", "s.error")


def bounds(summaries: DataFrame) -> tuple[DataFrame, int]:
    """(word, low, high) of every listed word over all summaries, and the bound of all others."""
    error = summaries.agg(F.coalesce(F.sum("error"), F.lit(0)).alias("error")).first()["error"]
    items = summaries.select("error", F.inline("words"))
    found = items.groupBy("word").agg(F.sum("count").alias("low"), F.sum("error").alias("listed"))
    return found.select("word", "low", (F.col("low") + error - F.col("listed")).alias("high")), error


def exact_top_words(summaries: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words over all summaries, equal counts in alphabetical order.

    ``counts`` are (word, count) rows of the same data, to be summed; they are read for
    undecided words only, or in full where even a word that no summary lists may rank.
    """
    known, unlisted = bounds(summaries)
    best = known.orderBy(F.desc("low"), F.asc("word")).limit(k)
    line = best.agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("n")).first()
    floor = line["low"] if line["n"] == k else 0
    if unlisted and unlisted >= floor:
        return top_words(counts.groupBy("word").agg(F.sum("count").alias("count")), k)
    able = known.where(F.col("high") >= floor)
    decided = able.where(F.col("low") == F.col("high")).select("word", F.col("low").alias("count"))
    open_ = able.where(F.col("low") < F.col("high")).select("word")
    n = open_.count()
    if not n:
        return top_words(decided, k)
    few = F.broadcast(open_) if n <= BROADCAST_WORDS else open_
    counted = counts.join(few, "word", "left_semi").groupBy("word").agg(F.sum("count").alias("count"))
    return top_words(decided.unionByName(counted), k)
