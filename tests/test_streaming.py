"""Streams over landed files against the same operators over the whole table."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from newslens import schemas as S
from newslens.functions.sentiment import load_lexicon
from newslens.operators import metrics as M
from newslens.operators.sentiment import with_sentiment
from newslens.plans import batch_report as B
from newslens.sources import messages
from newslens.sources.lexicon import sample_lexicon
from newslens.streaming import analytics as A
from newslens.streaming.ingest import start_ingest

T0 = datetime(2024, 1, 1, 9, 0)
ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def lexicon(spark):
    return load_lexicon(sample_lexicon(spark))


def land(spark, path, rows, mode="append"):
    frame = spark.createDataFrame(
        rows, "raw_id int, source string, title string, content string, timestamp timestamp"
    )
    encoded = messages.encode(frame, S.SCRAPED_MESSAGE, "timestamp")
    messages.write_topics(encoded.withColumn("topic", F.lit(S.SCRAPED_TOPIC)).coalesce(1), path, mode)
    return frame


def article(i, minute, text=None):
    words = ["that best words", "this lesser words", "plain words here"][i % 3]
    return (i, f"s{i % 2}", "t", text or words, T0 + timedelta(minutes=minute))


def run(spark, root, lexicon, start=None, files_per_batch=None, timing=None):
    stream = messages.stream_topics(spark, f"{root}/in", S.SCRAPED_TOPIC, files_per_batch=files_per_batch)
    counts = A.windowed_counts(A.scored_stream(stream, lexicon), start)
    A.start_analytics(counts, f"{root}/out", f"{root}/checkpoint", ONCE, timing_path=timing).awaitTermination()


def stored(spark, root):
    return spark.read.schema(S.ANALYTICS_RESULTS).parquet(f"{root}/out")


def values(df):
    return sorted((r["window_start"], r["metric_name"], r["metric_value"]) for r in df.collect())


def test_stream_equals_batch(spark, tmp_path, lexicon):
    root = str(tmp_path)
    rows = [article(i, i) for i in range(120)]
    frames = [land(spark, f"{root}/in", rows[i : i + 40]) for i in range(0, 120, 40)]
    run(spark, root, lexicon, files_per_batch=1, timing=f"{root}/timing")
    whole = frames[0].union(frames[1]).union(frames[2])
    closed = F.lit(T0 + timedelta(minutes=119)) - F.expr("INTERVAL 10 MINUTES")
    batch = B.windowed_metric_rows(with_sentiment(whole, lexicon)).where(F.col("window_end") <= closed)
    assert values(stored(spark, root)) == values(batch)
    assert stored(spark, root).select("id").distinct().count() == batch.count()
    logged = spark.read.parquet(f"{root}/timing")
    assert {r[0] for r in logged.select("processing_type").collect()} == {"streaming"}
    assert logged.agg(F.sum("records_processed")).collect()[0][0] == 105

    run(spark, root, lexicon)
    assert values(stored(spark, root)) == values(batch)


def test_a_new_stream_keeps_the_rows_of_the_old_one(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(0, 0), article(1, 60)])
    for checkpoint in ("one", "two", "one"):
        stream = messages.stream_topics(spark, f"{root}/in")
        counts = A.windowed_counts(A.scored_stream(stream, lexicon))
        A.start_analytics(counts, f"{root}/out", f"{root}/{checkpoint}", ONCE).awaitTermination()
    runs = spark.read.parquet(f"{root}/out").groupBy("run").count().collect()
    assert [r["count"] for r in runs] == [3, 3]


def test_late_messages_are_dropped_after_the_watermark(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(0, 0), article(1, 60)])
    run(spark, root, lexicon)
    land(spark, f"{root}/in", [article(2, 1), article(3, 51), article(4, 120)])
    run(spark, root, lexicon)
    counted = M.rollup_sentiment(stored(spark, root)).agg(F.sum("count")).collect()[0][0]
    # Kept: minutes 0, 51 and 60. Minute 1 came after its window closed, 120 is open.
    assert counted == 3


def test_bounded_run(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(i, m) for i, m in enumerate([-1, 0, 16, 44, 45, 200])])
    stream = messages.stream_topics(spark, f"{root}/in")
    counts = A.windowed_counts(A.scored_stream(stream, lexicon), T0, lateness="0 minutes")
    A.start_analytics(counts, f"{root}/out", f"{root}/checkpoint", ONCE).awaitTermination()
    starts = {r["window_start"] for r in stored(spark, root).collect()}
    assert starts == {T0 + timedelta(minutes=m) for m in (0, 15, 30)}


def test_windows_open_at_the_end_are_written_once(spark, tmp_path, lexicon):
    root = str(tmp_path)
    for minutes in ([0, 1, 60], [65, 70], [200]):
        land(spark, f"{root}/in", [article(i, m) for i, m in enumerate(minutes)])
        stream = messages.stream_topics(spark, f"{root}/in")
        counts = A.windowed_counts(A.scored_stream(stream, lexicon))
        query = A.start_analytics(counts, f"{root}/out", f"{root}/checkpoint", ONCE)
        query.awaitTermination()
        A.finish(spark, query, f"{root}/out", f"{root}/checkpoint")
    moods = M.metric_items(stored(spark, root), M.SENTIMENTS, M.SENTIMENT_ITEMS, ["window_start"])
    counted = {r[0]: r[1] for r in moods.groupBy("window_start").agg(F.sum("count")).collect()}
    assert counted == {T0 + timedelta(minutes=m): n for m, n in ((0, 2), (60, 3), (195, 1))}


def test_a_run_stops_after_its_last_window(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(i, m) for i, m in enumerate([0, 20, 40, 90])])
    stream = messages.stream_topics(spark, f"{root}/in")
    counts = A.windowed_counts(A.scored_stream(stream, lexicon), T0)
    query = A.start_analytics(counts, f"{root}/out", f"{root}/checkpoint", {"processingTime": "1 second"})
    A.await_windows(query, (T0 + timedelta(minutes=45)).replace(tzinfo=timezone.utc), poll=1.0)
    assert not query.isActive
    assert {r["window_start"] for r in stored(spark, root).collect()} == {T0 + timedelta(minutes=m) for m in (0, 15, 30)}


def test_failure_stops_the_query(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(0, 0), article(1, 60)])
    stream = messages.stream_topics(spark, f"{root}/in")
    counts = A.windowed_counts(A.scored_stream(stream, lexicon))
    (tmp_path / "file").write_text("x")
    query = A.start_analytics(counts, f"{root}/file/out", f"{root}/checkpoint", ONCE)
    with pytest.raises(Exception):
        query.awaitTermination()
    A.start_analytics(counts, f"{root}/out", f"{root}/checkpoint", ONCE).awaitTermination()
    assert stored(spark, root).count() == 3


def test_one_state_store_and_one_scan(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(0, 0), article(1, 60)])
    stream = messages.stream_topics(spark, f"{root}/in")
    counts = A.windowed_counts(A.scored_stream(stream, lexicon))
    query = A.start_analytics(counts, f"{root}/out", f"{root}/checkpoint", ONCE)
    query.awaitTermination()
    assert all(len(p["stateOperators"]) == 1 for p in query.recentProgress)


def test_ingest_stream(spark, tmp_path, lexicon):
    root = str(tmp_path)
    def crawl(*rows):
        spark.createDataFrame(rows, "url string, html string").write.mode("append").parquet(f"{root}/pages")

    crawl(("u1", "<title>One</title><body><article>best</article>"), ("u2", "<body></body>"))

    def land_feed(rows):
        feed = spark.createDataFrame(rows, "source string, title string, url string, timestamp timestamp")
        messages.write_topics(messages.route(feed, "timestamp"), f"{root}/in")

    def step():
        stream = messages.stream_topics(spark, f"{root}/in", *S.FEED_TOPICS.values())
        start_ingest(stream, f"{root}/pages", lexicon, f"{root}/out", f"{root}/checkpoint", ONCE).awaitTermination()

    land_feed([("BBC", "f", "u1", T0), ("Reuters", "f", "u2", T0)])
    step()
    land_feed([("BBC", "f", "u1", T0 + timedelta(minutes=1))])
    step()
    step()
    def written():
        return {n: spark.read.parquet(f"{root}/out/{n}").count() for n in ("raw", "processed", "rejected")}

    assert written() == {"raw": 3, "processed": 2, "rejected": 1}
    assert messages.read_topics(spark, f"{root}/out/topics", S.SCRAPED_TOPIC).count() == 2
    ids = spark.read.parquet(f"{root}/out/processed").select("raw_article_id").distinct().count()
    assert ids == 2
    # A page crawled after the first batch is found, and equal records of one time differ.
    crawl(("u3", "<title>Three</title><body><article>plain</article>"))
    land_feed([("BBC", "f", "u3", T0), ("BBC", "f", "u3", T0)])
    step()
    assert written() == {"raw": 5, "processed": 4, "rejected": 1}
    assert spark.read.parquet(f"{root}/out/raw").select("id").distinct().count() == 5


def test_markup_of_unasked_pages_is_not_moved(spark, tmp_path):
    from newslens.streaming.ingest import of_feed

    pages = spark.range(2000).selectExpr("concat('u', id) AS url", "repeat('x', 500) AS html")
    feed = spark.createDataFrame([("u5",), ("u6",), (None,)], "url string")
    wanted = of_feed(pages, feed)
    assert sorted(r["url"] for r in wanted.collect()) == ["u5", "u6"]
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange hashpartitioning(url" in line and "html" in line for line in plan.splitlines())
