"""Beginnings that very many suffixes share do not pass through the join."""

import pytest
from pyspark.sql import functions as F

from newslens.llm import suffix_dedup

from .conftest import frame, sentence
from .test_duplicates import brute_spans, found_spans

PASSAGE = sentence(70, 51)


def rows_with(n, passage=PASSAGE):
    rows = [(k, f"{sentence(100 + k, 20 + k)} {passage} {sentence(300 + k, 15)}") for k in range(n)]
    return rows + [(500, sentence(90, 80)), (501, f"{sentence(91, 30)} {sentence(90, 80)}"), (502, sentence(90, 80))]


@pytest.mark.parametrize("frequent", [2, 5, 1_000])
@pytest.mark.parametrize("passage", [PASSAGE, f"{PASSAGE} {PASSAGE}", "go " * 90])
def test_spans_do_not_depend_on_the_line(spark, monkeypatch, frequent, passage):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    rows = rows_with(12, passage)
    assert found_spans(suffix_dedup.repeated_passages(frame(spark, rows))) == brute_spans(rows)


def test_frequent_beginnings_are_bounded(spark, monkeypatch):
    groups = spark.range(1, 2_001).select(
        F.col("id").alias("key"), F.col("id").alias("n"), F.struct("id", F.col("id").alias("whole")).alias("least")
    )
    assert [g["key"] for g in suffix_dedup._frequent(groups)] == list(range(1_000, 2_001))
    monkeypatch.setattr(suffix_dedup, "FREQUENT_BEGINNINGS", 1_500)
    assert [g["key"] for g in suffix_dedup._frequent(groups)][0] == 1_335
