"""Words, counts and previews of article text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word rules of the streaming and the batch word count.
NON_WORD = r"\W+"
ASCII_LETTERS = r"^[a-zA-Z]+$"
MIN_WORD_LENGTH = 4
PREVIEW_CHARS = 200
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on",
    "at", "to", "for", "is", "are", "was", "were",
)

# Blanks are what Python's str.split() and str.strip() take for blank: the
# Unicode white space that (?U) lets \s match, and four separators of ASCII.
BLANK = r"\s\x1C-\x1F"
OUTER_BLANKS = f"(?U)^[{BLANK}]++|(?<![{BLANK}])[{BLANK}]++$"
BLANK_SEPARATED = f"(?U)[^{BLANK}]+"


def raw_words(content: Column) -> Column:
    """Pieces between runs of non-word characters, case kept, empty pieces included."""
    return F.split(content, NON_WORD)


def lower_words(content: Column) -> Column:
    """As ``raw_words`` over the text in lower case."""
    return F.split(F.lower(content), NON_WORD)


def is_long_word(word: Column) -> Column:
    """More than three characters, ASCII letters only."""
    return (F.length(word) >= MIN_WORD_LENGTH) & word.rlike(ASCII_LETTERS)


def is_stop_word(word: Column) -> Column:
    """Whether a word in lower case is a stop word."""
    return word.isin(*STOP_WORDS)


def clean_word(word: Column) -> Column:
    """Word in lower case without outer blanks; '' for null and for stop words."""
    cleaned = F.lower(strip(word))
    return F.when(word.isNull() | is_stop_word(cleaned), "").otherwise(cleaned)


def word_count(content: Column) -> Column:
    """Number of blank-separated words."""
    return F.regexp_count(content, F.lit(BLANK_SEPARATED))


def strip(text: Column) -> Column:
    """Text without outer blanks, Unicode blanks included."""
    return F.regexp_replace(text, OUTER_BLANKS, "")


def preview(content: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.substring(content, 1, chars)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column that is used inside another column's lambda would otherwise be inlined
    there and computed again for every array element. This is a fold over nothing, whose
    start value goes straight to the finish; unlike a transform, it copies nothing.
    """
    return F.aggregate(F.array(), value, lambda acc, _: acc, body)
