"""Sentiment labels for a table of articles."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.sentiment import (
    MAX_WORDS_IN_PLAN,
    NEGATED,
    PLAIN,
    Lexicon,
    LexiconTooLarge,
    clean,
    label,
    load_lexicon,
    modifier,
    sentiment,
)
from newslens.functions.text import let, lower_words

# A lexicon of up to this many words is sent to every task; a larger one is shuffled.
BROADCAST_WORDS = 1_000_000


def with_sentiment(
    articles: DataFrame,
    lexicon: Lexicon,
    modifiers: bool = True,
    threshold: int = 0,
    content: str = "content",
) -> DataFrame:
    """Add ``sentiment``. A projection: no shuffle, and valid on a stream."""
    return articles.withColumn(
        "sentiment", sentiment(F.col(content), lexicon, modifiers, threshold)
    )


def score_articles(
    articles: DataFrame,
    lexicon: DataFrame,
    key: str = "raw_id",
    modifiers: bool = True,
    threshold: int = 0,
    max_words: int = MAX_WORDS_IN_PLAN,
) -> DataFrame:
    """Add ``sentiment`` by the way that fits the size of the lexicon.

    Up to ``max_words`` the lexicon goes into the plan. A larger one is joined, and
    only its modifiers, a closed class of words, go into the plan.
    """
    try:
        return with_sentiment(articles, load_lexicon(lexicon, max_words), modifiers, threshold)
    except LexiconTooLarge:
        return join_sentiment(articles, lexicon, key, modifiers, threshold)


Labeller = Callable[[DataFrame, str], DataFrame]


def labeller(lexicon: DataFrame, max_words: int = MAX_WORDS_IN_PLAN) -> Lexicon | Labeller:
    """What labels articles by a lexicon of any size, chosen once for many batches.

    Small lexicons go into the plan; larger ones stay a table and are joined by each batch, as
    a function of articles and the name of their key.
    """
    try:
        return load_lexicon(lexicon, max_words)
    except LexiconTooLarge:
        return lambda articles, key: join_sentiment(articles, lexicon, key)


def labelled(articles: DataFrame, lexicon: Lexicon | Labeller, key: str) -> DataFrame:
    """Articles with their ``sentiment``; ``key`` may repeat only where the content does."""
    if isinstance(lexicon, Lexicon):
        return with_sentiment(articles, lexicon)
    return lexicon(articles, key)


def join_sentiment(
    articles: DataFrame,
    lexicon: DataFrame,
    key: str = "raw_id",
    modifiers: bool = True,
    threshold: int = 0,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """Add ``sentiment`` by joining the words of each article with the lexicon.

    ``key`` must be unique. The polar words are counted and, up to ``broadcast_words``,
    broadcast, so that words meet their scores where they are read and only the hits of
    an article are shuffled. Beyond that, words are summed per article and shuffled by
    word; a word of most articles is split over tasks by adaptive execution, for which
    the lexicon side holds each word once. The text is shuffled once, to meet its label.
    """
    cleaned = clean(lexicon)
    closed_class = load_lexicon(cleaned.where("kind <> 'polar'"), None)
    polar = cleaned.where("kind = 'polar'").select("word", "score")
    small = polar.count() <= broadcast_words

    def weighed(words: Column) -> Column:
        return F.transform(
            words,
            lambda w, i: F.struct(
                w.alias("word"),
                (modifier(words, i, closed_class) if modifiers else F.lit(PLAIN * PLAIN))
                .cast("bigint")
                .alias("factor"),
            ),
        )

    terms = articles.select(key, F.inline(let(lower_words(F.col("content")), weighed)))
    terms = terms.where("word <> ''")
    if small:
        hits = terms.withColumn("n", F.lit(1).cast("bigint")).join(F.broadcast(polar), "word")
    else:
        summed = terms.groupBy(key, "word").agg(
            F.sum("factor").alias("factor"), F.count(F.lit(1)).alias("n")
        )
        hits = summed.join(polar.hint("shuffle_merge"), "word")
    scores = (
        hits.groupBy(key)
        .agg(F.sum(F.col("score") * F.col("factor")).alias("total"), F.sum("n").alias("hits"))
        .select(key, label(F.col("total"), F.col("hits"), threshold).alias("sentiment"))
    )
    return (
        articles.join(scores, key, "left")
        .withColumn("sentiment", F.coalesce("sentiment", F.lit("neutral")))
    )


def with_custom_sentiment(
    articles: DataFrame,
    scorer: Callable[[pd.Series], pd.Series],
    threshold: float = 0.0,
    content: str = "content",
) -> DataFrame:
    """Add ``sentiment`` from a caller's own scorer, called once per Arrow batch.

    The scorer maps a series of texts to a series of polarities; null and empty texts
    never reach it and are neutral.
    """
    polarity = F.pandas_udf(scorer, "double")
    text = F.col(content)
    value = F.when(text.isNull() | (text == ""), F.lit(None)).otherwise(polarity(text))
    scored = articles.withColumn("_polarity", value)
    return scored.withColumn(
        "sentiment",
        F.when(F.col("_polarity") > threshold, "positive")
        .when(F.col("_polarity") < -threshold, "negative")
        .otherwise("neutral"),
    ).drop("_polarity")
