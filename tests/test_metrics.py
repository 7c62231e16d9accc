import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newslens.operators import metrics as M
from newslens.operators import timing
from newslens.operators import windows as Win
from newslens.plans import batch_report as B
from newslens.sources.sinks import read_metrics, stream_id, write_metrics

T0 = datetime(2024, 1, 1, 9, 0)

ROWS = [
    (1, "A", "alpha alpha beta", "positive", T0),
    (2, "A", "beta gamma", "negative", T0 + timedelta(minutes=14, seconds=59)),
    (3, "B", "alpha", "positive", T0 + timedelta(minutes=15)),
    (4, "B", None, "neutral", T0 + timedelta(minutes=50)),
]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(
        ROWS, "raw_id int, source string, content string, sentiment string, timestamp timestamp"
    )


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_sources(scored):
    stats = M.with_average_length(M.source_statistics(scored))
    assert rows(stats, "source", "article_count", "total_length", "avg_length") == [
        ("A", 2, 26, 13.0),
        ("B", 2, 5, 3.0),
    ]


def test_shares(spark, scored):
    shares = M.with_share(M.sentiment_distribution(scored))
    assert rows(shares, "sentiment", "share") == [
        ("negative", 25.0), ("neutral", 25.0), ("positive", 50.0),
    ]
    empty = spark.createDataFrame([("x", 0)], "sentiment string, count bigint")
    assert rows(M.with_share(empty), "share") == [(0.0,)]


def test_one_scan_equals_two(scored):
    both = M.sentiment_and_sources(scored)
    assert rows(both, "metric_name", "key", "count", "total_length") == sorted(
        [("sentiment_distribution", k, n, None) for k, n in rows(M.sentiment_distribution(scored), "sentiment", "count")]
        + [("source_statistics", *r) for r in rows(M.source_statistics(scored), "source", "article_count", "total_length")],
        key=repr,
    )


def test_facts_equal_the_separate_counts(scored):
    columns = ["window_start", "window_end", "metric_name", "key", "count", "total_length"]
    framed = Win.with_window(scored)
    window = ["window_start", "window_end"]
    facts = M.report(M.count_facts(M.article_facts(framed, window), window), 10, window)
    assert rows(facts, *columns) == rows(B.windowed_report(scored), *columns)


def test_batch_facts(scored):
    columns = ["metric_name", "key", "count", "total_length"]
    facts = M.report(M.count_facts(M.article_facts(scored, batch=True)), 5)
    assert rows(facts, *columns) == rows(B.batch_report(scored), *columns)


def test_metric_rows(scored):
    stored = {r["metric_name"]: r for r in B.batch_metric_rows(scored, F.lit(T0)).collect()}
    assert json.loads(stored["word_counts_batch"]["metric_value"]) == [
        {"word": "alpha", "count": 3}, {"word": "beta", "count": 2}, {"word": "gamma", "count": 1},
    ]
    assert json.loads(stored["source_statistics_batch"]["metric_value"])[0] == {
        "source": "A", "count": 2, "total_length": 26,
    }
    assert {r["processing_type"] for r in stored.values()} == {"batch"}
    assert len({r["id"] for r in stored.values()}) == 3


def test_source_parts_change_rows_but_not_answers(scored):
    at = F.lit(T0)
    report = B.batch_report(scored).withColumn("window_start", at).withColumn("window_end", at)
    one, more = M.metric_rows(report, "batch"), M.metric_rows(report, "batch", parts=64)
    assert (one.count(), more.count()) == (3, 4)
    columns = ["source", "article_count", "total_length"]
    assert rows(M.rollup_sources(one, "_batch"), *columns) == rows(M.rollup_sources(more, "_batch"), *columns)


def test_rollups(scored):
    stored = B.windowed_metric_rows(scored, top=1)
    assert rows(M.rollup_sentiment(stored), "sentiment", "count") == [
        ("negative", 1), ("neutral", 1), ("positive", 2),
    ]
    assert rows(M.rollup_sources(stored), "source", "article_count", "total_length") == [
        ("A", 2, 26), ("B", 2, 5),
    ]
    # The cut to one word per window loses beta and gamma.
    assert rows(M.rollup_words(stored), "word", "count") == [("alpha", 3)]


def test_recent(spark, scored, tmp_path):
    write_metrics(B.windowed_metric_rows(scored), str(tmp_path), "a")
    write_metrics(B.batch_metric_rows(scored, F.lit(T0 + timedelta(days=1))), str(tmp_path), "b")
    recent = M.recent_metrics(read_metrics(spark, str(tmp_path)), n=2).collect()
    assert [(r["metric_name"], r["window_start"]) for r in recent] == [
        ("sentiment_distribution", T0 + timedelta(minutes=45)),
        ("source_statistics", T0 + timedelta(minutes=45)),
    ]
    plan = M.recent_metrics(read_metrics(spark, str(tmp_path)))._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(processing_type" in plan.toString()


def test_epoch_is_replaced(spark, scored, tmp_path):
    stored = B.windowed_metric_rows(scored)
    for run, epoch in (("a", 0), ("a", 1), ("a", 1), ("a", 0), ("b", 0)):
        write_metrics(stored, str(tmp_path), run, epoch)
    assert read_metrics(spark, str(tmp_path)).count() == 3 * stored.count()
    with pytest.raises(RuntimeError):
        stream_id(stored)


def test_run_batch(spark, scored, tmp_path):
    row = B.run_batch(scored, str(tmp_path / "m"), str(tmp_path / "t")).collect()[0]
    assert row["records_processed"] == 4 and row["processing_type"] == "batch"
    B.run_batch(scored, str(tmp_path / "m"), str(tmp_path / "t"))
    logged = spark.read.parquet(str(tmp_path / "t")).collect()
    assert [r["records_processed"] for r in logged] == [4, 4]
    assert all(r["records_per_second"] > 0 for r in logged)
    assert read_metrics(spark, str(tmp_path / "m")).count() == 6


def test_timing(spark):
    log = spark.createDataFrame(
        [
            ("batch", T0, T0 + timedelta(seconds=4), 10),
            ("batch", T0, T0 + timedelta(seconds=2), 10),
            ("streaming", T0, T0, 7),
        ],
        "processing_type string, start_time timestamp, end_time timestamp, records bigint",
    )
    metrics = timing.timing_metrics(log)
    assert rows(metrics, "processing_duration_seconds", "records_per_second") == [
        (0.0, 0.0), (2.0, 5.0), (4.0, 2.5),
    ]
    columns = ["processing_type", "avg_duration", "avg_throughput", "max_throughput", "min_throughput", "num_executions"]
    assert rows(timing.compare_performance(metrics), *columns) == [
        ("batch", 3.0, 3.75, 5.0, 2.5, 2), ("streaming", 0.0, 0.0, 0.0, 0.0, 1),
    ]


def test_windows(spark, scored):
    counts = Win.tumbling_counts(scored)
    assert [c for _, c in rows(counts, "window_start", "count")] == [2, 1, 1]
    assert rows(Win.bounded_run(scored, T0), "raw_id") == [(1,), (2,), (3,)]
    assert rows(Win.since(scored, T0 + timedelta(minutes=15)), "raw_id") == [(3,), (4,)]
    assert rows(Win.with_run(scored, T0), "raw_id", "run", "window_no") == [
        (1, 1, 1), (2, 1, 1), (3, 1, 2), (4, 2, 1),
    ]
