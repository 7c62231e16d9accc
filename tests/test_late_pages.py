"""Records that wait for their pages, and records that are sent again."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from newslens.functions.sentiment import load_lexicon
from newslens.schemas import FEED_MESSAGE
from newslens.sources import messages
from newslens.sources.lexicon import sample_lexicon
from newslens.streaming import late_pages as L

T0 = datetime(2024, 1, 1, 9, 0)
ONCE = {"availableNow": True}


def at(minute):
    return T0 + timedelta(minutes=minute)


def send(spark, root, rows):
    """Feed messages (key, source, url, minute) as one file."""
    frame = spark.createDataFrame([(k, s, "t", u, at(m)) for k, s, u, m in rows], "key string, source string, title string, url string, timestamp timestamp")
    encoded = messages.encode(frame, FEED_MESSAGE, "timestamp", "key").withColumn("topic", F.lit("bbc_news"))
    encoded.coalesce(1).write.mode("append").json(f"{root}/topics")


def crawl(spark, root, rows):
    html = "<title>{0}</title><body><article>best {0} words</article>"
    frame = spark.createDataFrame([(u, html.format(u) if ok else "<p>", at(m)) for u, m, ok in rows], "url string, html string, crawled_at timestamp")
    frame.coalesce(1).write.mode("append").parquet(f"{root}/pages")


def ingest(spark, root, lexicon, **options):
    landed = messages.stream_topics(spark, f"{root}/topics", files_per_batch=1)
    L.start_waiting_ingest(
        L.feed_records(landed), L.crawled_pages(spark, f"{root}/pages", 1), lexicon, f"{root}/out", f"{root}/c", ONCE, **options
    ).awaitTermination()


def urls(spark, root, name):
    table = spark.read.parquet(f"{root}/out/{name}")
    if name == "processed":
        return sorted(r["title"] for r in table.collect())
    return sorted(r["url"] or "" for r in table.collect())


def test_late_and_missing_pages(spark, tmp_path):
    root, lexicon = str(tmp_path), load_lexicon(sample_lexicon(spark))
    send(spark, root, [("1", "BBC", "a", 0), ("2", "BBC", "b", 1), ("3", "BBC", "c", 2), ("4", "BBC", "d", 3), ("5", "BBC", None, 4)])
    # a is there before its record and again after it; d holds no article; an old page of c does not count.
    crawl(spark, root, [("a", -30, True), ("a", 5, True), ("d", 3, False), ("c", -5000, True)])
    ingest(spark, root, lexicon)
    assert urls(spark, root, "processed") == ["a"]
    crawl(spark, root, [("b", 40, True), ("c", 63, True)])
    ingest(spark, root, lexicon)
    assert urls(spark, root, "processed") == ["a", "b"]
    # Time goes on: what still waits is given up, once; a page of b that comes again changes nothing.
    send(spark, root, [("6", "BBC", "later", 5000)])
    crawl(spark, root, [("b", 41, True), ("other", 5000, True)])
    for _ in range(2):
        ingest(spark, root, lexicon)
    assert urls(spark, root, "processed") == ["a", "b"]
    assert urls(spark, root, "rejected") == ["", "c", "d"]
    assert urls(spark, root, "raw") == ["", "a", "b", "c", "d"]
    ids = [r["id"] for r in spark.read.parquet(f"{root}/out/raw").collect()]
    assert len(ids) == len(set(ids))


def test_repeats_across_batches_and_a_restart(spark, tmp_path):
    root = str(tmp_path)

    def poll():
        landed = messages.stream_topics(spark, f"{root}/topics", files_per_batch=1)
        records = L.distinct_records(L.feed_records(landed, lateness="1 hour"))
        records.drop("timestamp").writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/c"
        ).trigger(**ONCE).start().awaitTermination()
        return sorted((r["source"], r["url"] or "") for r in spark.read.parquet(f"{root}/out").collect())

    send(spark, root, [("1", "BBC", "a", 0), ("2", "BBC", "a", 0), ("3", "Reuters", "a", 1), ("4", "BBC", None, 1), ("5", "BBC", None, 1)])
    send(spark, root, [("6", "BBC", "a", 10), ("7", "BBC", "b", 11)])
    want = [("BBC", ""), ("BBC", ""), ("BBC", "a"), ("BBC", "b"), ("Reuters", "a")]
    assert poll() == want
    send(spark, root, [("8", "BBC", "a", 20), ("9", "BBC", "b", 30)])
    assert poll() == want
    # Long after, the record counts as new: the state is bounded by the watermark.
    send(spark, root, [("10", "BBC", "x", 500)])
    poll()
    send(spark, root, [("11", "BBC", "a", 501)])
    assert poll() == sorted([*want, ("BBC", "x"), ("BBC", "a")])


def test_pages_without_a_time_of_their_own(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("a", "<p>")], "url string, html string").write.parquet(f"{root}/pages")
    pages = L.crawled_pages(spark, f"{root}/pages")
    assert pages.columns == ["url", "html", "crawled_at"] and pages.schema["crawled_at"].dataType.typeName() == "timestamp"


def test_distinct_messages_keep_their_layout(spark, tmp_path):
    root = str(tmp_path)
    send(spark, root, [("1", "BBC", "a", 0), ("2", "BBC", "a", 1), ("3", "BBC", "b", 1)])
    landed = messages.stream_topics(spark, f"{root}/topics")
    distinct = L.distinct_messages(landed, "key", "1 hour")
    assert distinct.columns == landed.columns
    distinct.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").trigger(**ONCE).start().awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 2
