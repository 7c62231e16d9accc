"""Streams that keep partial counts in files: against the whole table, replays, late rows, open windows."""

import random
import time
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.functions.sentiment import Lexicon, load_lexicon
from newslens.operators import metrics as M
from newslens.operators import summaries as Sum
from newslens.operators.sentiment import labeller, score_articles, with_sentiment
from newslens.plans import batch_report as B
from newslens.sources import messages
from newslens.sources.lexicon import read_lexicon, sample_lexicon
from newslens.streaming import analytics as A
from newslens.streaming import partials as P
from newslens.streaming.progress import Account, observed

from test_streaming import ONCE, T0, article, land


@pytest.fixture(scope="module")
def lexicon(spark):
    return load_lexicon(sample_lexicon(spark))


def run(spark, root, lexicon, finish=False, **options):
    stream = messages.stream_topics(spark, f"{root}/in", files_per_batch=1)
    query = P.start_partial_analytics(
        A.scored_stream(stream, lexicon), f"{root}/out", f"{root}/partials", f"{root}/checkpoint", ONCE, **options
    )
    query.awaitTermination()
    if finish:
        P.write_open_windows(spark, query, f"{root}/out", f"{root}/partials")
    return query


def stored(spark, root):
    rows = M.latest(spark.read.parquet(f"{root}/out")).where(F.col("metric_name") != Sum.SUMMARY)
    return sorted((r["window_start"], r["metric_name"], r["metric_value"]) for r in rows.collect())


def expected(frame, lexicon):
    rows = B.windowed_metric_rows(with_sentiment(frame, lexicon))
    return sorted((r["window_start"], r["metric_name"], r["metric_value"]) for r in rows.collect())


def test_equals_the_whole_table(spark, tmp_path, lexicon):
    root = str(tmp_path)
    frames = [land(spark, f"{root}/in", [article(i, i) for i in range(a, a + 40)]) for a in (0, 40, 80)]
    query = run(spark, root, lexicon)
    whole = frames[0].union(frames[1]).union(frames[2])
    closed = T0 + timedelta(minutes=109)
    want = [r for r in expected(whole, lexicon) if r[0] + timedelta(minutes=15) <= closed]
    assert stored(spark, root) == want and want
    # The stream itself has no state at all.
    assert query.lastProgress["stateOperators"] == []
    run(spark, root, lexicon, finish=True)
    assert stored(spark, root) == expected(whole, lexicon)
    counts = P.all_counts(spark, f"{root}/partials").where(F.col("metric_name") == M.SENTIMENTS)
    assert counts.agg(F.sum("count")).collect()[0][0] == 120


def test_a_replayed_batch_adds_nothing(spark, tmp_path, lexicon, monkeypatch):
    root = str(tmp_path)
    frames = [land(spark, f"{root}/in", [article(i, i) for i in range(a, a + 30)]) for a in (0, 30, 60)]
    write = P.partial_writer(f"{root}/out", f"{root}/partials")
    whole = frames[0].union(frames[1]).union(frames[2])
    monkeypatch.setattr(P, "stream_id", lambda batch: "one")
    for epoch in (0, 1, 1, 2, 2, 2):
        batch = with_sentiment(frames[epoch], lexicon)
        if epoch == 2:
            # A try that fails after its last window was written, before the clock was.
            monkeypatch.setattr(P, "_drop", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                write(batch, epoch)
            monkeypatch.undo()
            monkeypatch.setattr(P, "stream_id", lambda batch: "one")
        write(batch, epoch)
    closed = T0 + timedelta(minutes=79)
    assert stored(spark, root) == [r for r in expected(whole, lexicon) if r[0] + timedelta(minutes=15) <= closed]
    counts = P.all_counts(spark, f"{root}/partials").where(F.col("metric_name") == M.SENTIMENTS)
    assert counts.agg(F.sum("count")).collect()[0][0] == 90


def test_late_messages_are_counted(spark, tmp_path, lexicon):
    root = str(tmp_path)
    for minutes in ([0, 60], [1, 2, 51, 120]):
        land(spark, f"{root}/in", [article(i, m) for i, m in enumerate(minutes)])
    run(spark, root, lexicon)
    late = P.late_counts(spark, f"{root}/partials").collect()
    assert [(r["window_start"], r["count"]) for r in late] == [(T0, 2)]
    moods = M.metric_items(M.latest(spark.read.parquet(f"{root}/out")), M.SENTIMENTS, M.SENTIMENT_ITEMS)
    assert moods.agg(F.sum("count")).collect()[0][0] == 3


def test_open_windows_then_a_continuing_run(spark, tmp_path, lexicon):
    """Stored while open, then closed: every message counts once, as in a single run."""
    root = str(tmp_path)
    frames = [land(spark, f"{root}/in", [article(i, i) for i in range(20)])]
    run(spark, root, lexicon, finish=True)
    frames.append(land(spark, f"{root}/in", [article(i, i) for i in range(20, 90)]))
    run(spark, root, lexicon, finish=True)
    assert stored(spark, root) == expected(frames[0].union(frames[1]), lexicon)
    # The way through the state store is read the same way.
    other = f"{root}/other"
    for _ in range(2):
        stream = messages.stream_topics(spark, f"{root}/in", files_per_batch=1)
        query = A.start_analytics(A.windowed_counts(A.scored_stream(stream, lexicon)), f"{other}/out", f"{other}/c", ONCE)
        query.awaitTermination()
        A.finish(spark, query, f"{other}/out", f"{other}/c")
    assert stored(spark, other) == stored(spark, root)


def test_settled_dates_go(spark, tmp_path, lexicon):
    root = str(tmp_path)
    day = 24 * 60
    frames = [land(spark, f"{root}/in", [article(i, m) for i, m in enumerate(ms)]) for ms in ([0, 10], [day, day + 30], [2 * day], [2 * day + 60])]
    run(spark, root, lexicon, finish=True)
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.union(f)
    assert stored(spark, root) == expected(whole, lexicon)
    dates = {str(r[0]) for r in P.open_counts(spark, f"{root}/partials").select("window_date").distinct().collect()}
    assert "2024-01-01" not in dates and "2024-01-03" in dates
    assert P.all_counts(spark, f"{root}/partials").where(F.col("metric_name") == M.SENTIMENTS).agg(F.sum("count")).collect()[0][0] == 6
    assert spark.read.parquet(f"{root}/partials/clock").count() <= 2


def test_bounded_run(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(i, m) for i, m in enumerate([-1, 0, 16, 44, 45, 200])])
    run(spark, root, lexicon, start=T0, windows=3, lateness="0 minutes")
    assert {r[0] for r in stored(spark, root)} == {T0 + timedelta(minutes=m) for m in (0, 15, 30)}


SUMMARY = T.StructType([T.StructField("w", T.LongType()), T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])


@pytest.mark.parametrize("seed,size,k", [(1, 5, 3), (2, 2, 4), (3, 40, 10), (4, 1, 1), (5, 8, 100)])
def test_exact_ranking_from_summaries(spark, seed, size, k):
    r = random.Random(seed)
    rows = {(w, f"w{r.randint(0, 30)}"): r.randint(1, 9) ** 2 for w in range(6) for _ in range(25)}
    counts = spark.createDataFrame([(w, x, n) for (w, x), n in rows.items()], SUMMARY)
    total = Counter()
    for (_, x), n in rows.items():
        total[x] += n
    summaries = Sum.summarise(counts, ["w"], size)
    known, error = Sum.bounds(summaries)
    for row in known.collect():
        assert row["low"] <= total[row["word"]] <= row["high"]
    listed = {row["word"] for row in known.collect()}
    assert all(n <= error for x, n in total.items() if x not in listed)
    got = Sum.exact_top_words(summaries, counts.select("word", "count"), k)
    assert [(x["word"], x["count"]) for x in got.collect()] == sorted(total.items(), key=lambda t: (-t[1], t[0]))[:k]


def test_decided_words_are_not_counted(spark):
    """Counts are read for undecided words only: here there is none, so broken ones do not matter."""
    rows = [(w, x, n) for w in (1, 2) for x, n in (("one", 9), ("two", 5), ("three", 1))]
    summaries = Sum.summarise(spark.createDataFrame(rows, SUMMARY), ["w"], 2)
    broken = spark.createDataFrame([("one", 1)], "word string, count long")
    got = Sum.exact_top_words(summaries, broken, 2).collect()
    assert [tuple(r) for r in got] == [("one", 18), ("two", 10)]


def test_a_large_lexicon_labels_alike_in_batch_and_stream(spark, tmp_path, lexicon):
    """200,000 words: more than go into a plan."""
    root = str(tmp_path)
    large = spark.range(200_000).select(
        F.concat(F.lit("w"), F.col("id")).alias("word"), (F.col("id") % 7 - 3).cast("int").alias("score"), F.lit("polar").alias("kind")
    ).unionByName(sample_lexicon(spark))
    large.write.parquet(f"{root}/lexicon")
    table = read_lexicon(spark, f"{root}/lexicon")
    texts = [f"w{i * 37 % 200_000} not w{i * 91 % 200_000} best" if i % 5 else "best that words" for i in range(60)]
    frame = land(spark, f"{root}/in", [article(i, i, t) for i, t in enumerate(texts)])
    found = labeller(table)
    assert not isinstance(found, Lexicon)
    stream = A.parsed_stream(messages.stream_topics(spark, f"{root}/in"))
    query = P.start_partial_analytics(
        stream, f"{root}/out", f"{root}/partials", f"{root}/c", ONCE, score=lambda new: A.scored_batch(new, found)
    )
    query.awaitTermination()
    P.write_open_windows(spark, query, f"{root}/out", f"{root}/partials")
    whole = score_articles(frame, table, key="raw_id")
    assert stored(spark, root) == sorted(
        (r["window_start"], r["metric_name"], r["metric_value"]) for r in B.windowed_metric_rows(whole).collect()
    )
    in_plan = load_lexicon(table, None)
    assert sorted(map(tuple, with_sentiment(frame, in_plan).select("raw_id", "sentiment").collect())) == sorted(
        map(tuple, whole.select("raw_id", "sentiment").collect())
    )


def test_numbers_of_a_batch_are_reported(spark, tmp_path, lexicon):
    root = str(tmp_path)
    land(spark, f"{root}/in", [article(i, i) for i in range(7)])
    broken = spark.createDataFrame([("not json", T0)], "value string, timestamp timestamp")
    messages.write_topics(broken.withColumn("topic", F.lit("scraped_articles")), f"{root}/in")
    account = Account()
    spark.streams.addListener(account)
    try:
        stream = observed(A.parsed_stream(messages.stream_topics(spark, f"{root}/in")))
        P.start_partial_analytics(
            stream, f"{root}/out", f"{root}/partials", f"{root}/c", ONCE, score=lambda new: A.scored_batch(new, lexicon)
        ).awaitTermination()
        for _ in range(50):
            if account.batches:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(account)
    assert (account.total("messages"), account.total("unreadable")) == (8, 1)
