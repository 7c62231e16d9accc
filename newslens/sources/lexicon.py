"""Lexicon tables: (word, score, kind), scores in thousandths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYOUT = "word string, score int, kind string"

# A small lexicon over words of the invented prose in the test tables. A
# real one is read from a table.
SAMPLE = (
    ("best", 1000, "polar"),
    ("that", 200, "polar"),
    ("with", 300, "polar"),
    ("this", -400, "polar"),
    ("from", -250, "polar"),
    ("by", 150, "polar"),
    ("le", 100, "polar"),
    ("que", -300, "polar"),
    ("und", 250, "polar"),
    ("der", -200, "polar"),
    ("los", 350, "polar"),
    ("las", -350, "polar"),
    ("for", -50, "polar"),
    ("was", 50, "polar"),
    ("is", 1200, "intensifier"),
    ("est", 1500, "intensifier"),
    ("are", 500, "intensifier"),
    ("no", 0, "negator"),
    ("not", 0, "negator"),
    ("nicht", 0, "negator"),
    ("pas", 0, "negator"),
    ("as", 0, "negator"),
)


def sample_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SAMPLE), LAYOUT)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).selectExpr(
        "lower(word) AS word", "cast(score AS int) AS score", "kind"
    )
