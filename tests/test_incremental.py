"""Incremental batch: equal to a full run, reads new files only, survives failures."""

import pytest
from pyspark.sql import functions as F

from newslens.__main__ import main
from newslens.functions.sentiment import load_lexicon
from newslens.operators.sentiment import with_sentiment
from newslens.plans import batch_report as B
from newslens.plans import incremental as I
from newslens.sources.lexicon import sample_lexicon


@pytest.fixture(scope="module")
def score(spark):
    lexicon = load_lexicon(sample_lexicon(spark))
    return lambda articles: with_sentiment(articles, lexicon)


def land(spark, path, ids):
    rows = [(str(i), f"s{i % 3}", "t", ["best that words", "this lesser words", "plain"][i % 3] + f" w{i % 7}") for i in ids]
    spark.createDataFrame(rows, "raw_article_id string, source string, title string, content string").coalesce(1).write.mode("append").parquet(path)


def rows(df):
    return sorted((r["metric_name"], r["key"], r["count"], r["total_length"]) for r in df.collect())


def full(spark, path, score):
    return rows(B.batch_report(score(spark.read.parquet(path))))


def test_slices_equal_a_full_run_and_read_new_files_only(spark, tmp_path, score):
    articles, store = str(tmp_path / "articles"), str(tmp_path / "store")
    taken = []
    for number, ids in enumerate((range(0, 30), range(30, 50), range(50, 51))):
        land(spark, articles, ids)
        seen = []

        def watched(new):
            seen.extend(new.inputFiles())
            return score(new)

        got, files = I.take_slice(spark, articles, store, watched)
        assert got == number and len(files) == 1 and len(seen) == 1
        assert not set(seen) & set(taken)
        taken += seen
        assert rows(I.stored_report(spark, store)) == full(spark, articles, score)
    assert I.take_slice(spark, articles, store, score) == (None, [])
    assert rows(I.stored_report(spark, store)) == full(spark, articles, score)


def test_a_failed_run_leaves_nothing_that_counts(spark, tmp_path, score, monkeypatch):
    articles, store = str(tmp_path / "articles"), str(tmp_path / "store")
    land(spark, articles, range(10))
    I.take_slice(spark, articles, store, score)
    before = rows(I.stored_report(spark, store))
    land(spark, articles, range(10, 25))

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(I, "commit", lost)
    with pytest.raises(RuntimeError):
        I.take_slice(spark, articles, store, score)
    monkeypatch.undo()
    assert rows(I.stored_report(spark, store)) == before
    assert I.take_slice(spark, articles, store, score)[0] == 1
    assert rows(I.stored_report(spark, store)) == full(spark, articles, score)
    with pytest.raises(RuntimeError):
        I.commit(spark, store, 1, 0)


def test_slices_are_merged(spark, tmp_path, score):
    articles, store = str(tmp_path / "articles"), str(tmp_path / "store")
    for i in range(3):
        land(spark, articles, range(i * 5, i * 5 + 5))
        I.take_slice(spark, articles, store, score)
    assert not I.merge_slices(spark, store, 4) and I.merge_slices(spark, store, 3)
    assert I.last_commit(spark, store) == (3, 3)
    land(spark, articles, range(15, 30))
    assert I.take_slice(spark, articles, store, score)[0] == 4
    assert rows(I.stored_report(spark, store)) == full(spark, articles, score)


def test_empty_store(spark, tmp_path):
    assert I.stored_report(spark, str(tmp_path / "none")).count() == 0


def test_job(spark, tmp_path, capsys):
    p = lambda name: str(tmp_path / name)
    sample_lexicon(spark).write.parquet(p("lexicon"))
    records = []
    for ids in (range(12), range(12, 20), ()):
        if ids:
            land(spark, p("articles"), ids)
        (row,) = main(["batch", "--articles", p("articles"), "--lexicon", p("lexicon"), "--metrics", p("metrics"),
                       "--timing", p("timing"), "--store", p("store")], spark)
        records.append(row.collect()[0]["records_processed"])
    assert records == [12, 8, 0]
    assert spark.read.parquet(p("metrics")).select("run").distinct().count() == 3
    whole = spark.read.parquet(p("metrics")).where(F.col("metric_name") == "source_statistics_batch").select("metric_value").distinct()
    assert whole.count() == 2
