"""Sentiment of a text against a lexicon, as one expression per row.

A lexicon is a table ``(word, score, kind)`` with scores in thousandths:

* ``polar``: the score is the polarity of the word, -1000 to 1000;
* ``intensifier``: the score multiplies the polarity of the next word;
* ``negator``: turns the polarity of the next word (or of the word after a following
  intensifier) around and halves it.

The polarity of a text is the mean over its polar words. All sums are integers, so a
label never depends on the order of addition.

``clean`` gives every lexicon one meaning, however it is used afterwards: rows without a
word, or without a score where one is needed, count for nothing; the scores of a word that
is listed several times as one kind are added up; an unknown or missing kind is an error.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.text import let, lower_words

# The weight of a word is score x intensity x negation, each in thousandths.
PLAIN = 1000
NEGATED = -500

# Above this many words the lexicon stays a table and is joined instead.
MAX_WORDS_IN_PLAN = 10_000


class LexiconTooLarge(ValueError):
    pass


@dataclass(frozen=True)
class Lexicon:
    """A lexicon small enough to travel inside the query plan."""

    polar: str
    slots: int
    intensifiers: str
    negators: tuple[str, ...]

    def score(self, word: Column) -> Column:
        """Polarity of a word, null when it is not polar.

        The words are spread over the slots of an array by hash, so a lookup reads one
        slot whatever the size of the lexicon.
        """
        table = F.from_json(F.lit(self.polar), "array<map<string,bigint>>")
        return F.try_element_at(F.get(table, F.pmod(F.hash(word), F.lit(self.slots))), word)

    def intensity(self, word: Column) -> Column:
        return F.try_element_at(F.from_json(F.lit(self.intensifiers), "map<string,bigint>"), word)

    def negates(self, word: Column) -> Column:
        return word.isin(*self.negators) if self.negators else F.lit(False)


KINDS = ("polar", "intensifier", "negator")


def clean(table: DataFrame) -> DataFrame:
    """One row per word and kind: (word, kind, score bigint)."""
    known = F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))
    kind = F.when(known, F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown lexicon kind "), F.coalesce("kind", F.lit("null"))))
    )
    rows = table.select("word", kind.alias("kind"), F.col("score").cast("bigint").alias("score"))
    used = F.col("score").isNotNull() | (F.col("kind") == "negator")
    return (
        rows.where(used & (F.col("word") != ""))
        .groupBy("word", "kind")
        .agg(F.coalesce(F.sum("score"), F.lit(0)).alias("score"))
    )


def load_lexicon(table: DataFrame, max_words: int | None = MAX_WORDS_IN_PLAN) -> Lexicon:
    """Read a lexicon that is known to be small; raise when it is not."""
    found = clean(table).select("word", "score", "kind", F.hash("word").alias("hash"))
    rows = (found.limit(max_words + 1) if max_words else found).collect()
    if max_words is None:
        max_words = len(rows)
    if len(rows) > max_words:
        raise LexiconTooLarge(f"lexicon holds more than {max_words} words")
    slots = max(16, 1 << (2 * len(rows)).bit_length())
    polar: list[dict[str, int]] = [{} for _ in range(slots)]
    intensifiers: dict[str, int] = {}
    negators = []
    for row in rows:
        if row["kind"] == "polar":
            polar[row["hash"] % slots][row["word"]] = row["score"]
        elif row["kind"] == "intensifier":
            intensifiers[row["word"]] = row["score"]
        else:
            negators.append(row["word"])
    return Lexicon(json.dumps(polar), slots, json.dumps(intensifiers), tuple(sorted(negators)))


def modifier(words: Column, i: Column, lexicon: Lexicon) -> Column:
    """What the one or two words before position ``i`` multiply its score by."""
    before, earlier = F.get(words, i - 1), F.get(words, i - 2)
    intensity = lexicon.intensity(before)
    negated = lexicon.negates(before) | (intensity.isNotNull() & lexicon.negates(earlier))
    return F.coalesce(intensity, F.lit(PLAIN)) * F.when(negated, NEGATED).otherwise(PLAIN)


def polarity(content: Column, lexicon: Lexicon, modifiers: bool = True) -> Column:
    """``struct(total, hits)``: summed weight and number of polar words; null for null."""

    def weigh(words: Column) -> Column:
        def weight(word: Column, i: Column) -> Column:
            factor = modifier(words, i, lexicon) if modifiers else F.lit(PLAIN * PLAIN)
            return lexicon.score(word) * factor

        return F.aggregate(
            F.transform(words, weight),
            F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("hits")),
            lambda acc, w: F.when(w.isNull(), acc).otherwise(
                F.struct((acc["total"] + w).alias("total"), (acc["hits"] + 1).alias("hits"))
            ),
        )

    return let(lower_words(content), weigh)


def label(total: Column, hits: Column, threshold: int = 0) -> Column:
    """Label of a mean polarity; ``threshold`` in thousandths, neutral up to it."""
    limit = hits * F.lit(threshold * PLAIN * PLAIN).cast("bigint")
    return (
        F.when(total > limit, "positive").when(total < -limit, "negative").otherwise("neutral")
    )


def sentiment(
    content: Column, lexicon: Lexicon, modifiers: bool = True, threshold: int = 0
) -> Column:
    """positive, negative or neutral; neutral for null and empty text."""
    return let(
        polarity(content, lexicon, modifiers),
        lambda p: label(p["total"], p["hits"], threshold),
    )
