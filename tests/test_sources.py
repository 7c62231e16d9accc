import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import schemas as S
from newslens.operators import quality as Q
from newslens.plans import ingest as I
from newslens.functions.sentiment import load_lexicon
from newslens.session import drop_table, new_table_path, shared_folder
from newslens.sources import feeds, jdbc, kafka, messages
from newslens.sources.lexicon import read_lexicon, sample_lexicon

RSS = """<?xml version="1.0"?><rss><channel><title>Site</title><link>http://s</link>
<item><title>One &amp; two</title><link>http://s/1</link><guid>x</guid></item>
<item><title>Clip</title><link>http://s/videos/2</link></item>
</channel></rss>"""
EMPTY_RSS = "<rss><channel><title>Site</title></channel></rss>"


def test_rss(spark, tmp_path):
    (tmp_path / "a.xml").write_text(RSS)
    (tmp_path / "b.xml").write_text(EMPTY_RSS)
    feed = feeds.read_rss(spark, str(tmp_path), "BBC")
    assert sorted(map(tuple, feed.collect())) == [
        ("BBC", "Clip", "http://s/videos/2"), ("BBC", "One & two", "http://s/1"),
    ]
    assert [r["title"] for r in feeds.without_videos(feed).collect()] == ["One & two"]


def test_api(spark, tmp_path):
    good = {"response": {"status": "ok", "results": [
        {"webTitle": "A", "webUrl": "u1", "id": 1}, {"webTitle": "B", "webUrl": "u2"}]}}
    for i, body in enumerate([good, {"response": {}}, {"message": "limit"}, {"response": {"results": []}}]):
        (tmp_path / f"{i}.json").write_text(json.dumps(body, indent=1))
    feed = feeds.read_api(spark, str(tmp_path), "Guardian")
    assert sorted(map(tuple, feed.collect())) == [("Guardian", "A", "u1"), ("Guardian", "B", "u2")]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "all.json").write_text("\n".join(json.dumps(good) for _ in range(3)))
    assert feeds.read_api(spark, str(lines), "Guardian", one_per_file=False).count() == 6


def test_topics(spark, tmp_path):
    feed = spark.createDataFrame(
        [("BBC", "a", "u1"), ("Guardian", "b", "u2"), ("Reuters", "c", "u3"), ("Other", None, "u4")],
        S.FEED_MESSAGE,
    )
    routed = messages.route(feed)
    assert {r["topic"] for r in routed.collect()} == {
        "bbc_news", "guardian_news", "reuters_news", "other_news"
    }
    messages.write_topics(routed, str(tmp_path))
    read = messages.read_topics(spark, str(tmp_path), *S.FEED_TOPICS.values())
    decoded = messages.decode(read, S.FEED_MESSAGE)
    assert sorted(map(tuple, decoded.collect())) == [
        ("BBC", "a", "u1"), ("Guardian", "b", "u2"), ("Reuters", "c", "u3")
    ]
    assert messages.merge(routed, routed).count() == 8


def test_bad_messages_keep_their_row(spark):
    values = ['{"raw_id": 1, "source": "s", "title": "t", "content": "c"}', '{"raw_id": "x"}', "junk", None]
    rows = spark.createDataFrame([(v, datetime(2024, 1, 1)) for v in values], "value string, timestamp timestamp")
    got = messages.parse_envelope(rows).collect()
    assert tuple(got[0])[:4] == (1, "s", "t", "c")
    assert [r["raw_id"] for r in got] == [1, None, None, None]
    assert all(r["timestamp"] for r in got)
    binary = rows.withColumn("value", F.col("value").cast("binary"))
    assert messages.parse_envelope(binary).collect() == got


PAGES = [
    ("u1", "<title>One</title><body><article>best that</article>"),
    ("u2", "<title>Two</title><body></body>"),
]


def test_ingest(spark, tmp_path):
    feed = spark.createDataFrame(
        [("BBC", "f1", "u1", 0), ("BBC", "f1", "u1", 1), ("Reuters", "f2", "u2", 2), ("Reuters", "f3", "u9", 3)],
        "source string, title string, url string, position int",
    )
    pages = spark.createDataFrame(PAGES, "url string, html string")
    lexicon = load_lexicon(sample_lexicon(spark))
    answers = []
    for first in (True, False):
        out = I.ingest(feed, pages, lexicon, "position", extract_first=first)
        path = str(tmp_path / str(first))
        out.extracted.write.parquet(path)
        for done in (out, out.from_extracted(spark.read.parquet(path), lexicon)):
            answers.append(
                tuple(sorted(map(tuple, t.collect()), key=repr))
                for t in (done.raw, done.processed, done.rejected, done.messages)
            )
    raw, processed, rejected, scraped = (list(x) for x in zip(*answers))
    for table in (raw, processed, rejected, scraped):
        assert all(t == table[0] for t in table)
    assert len(raw[0]) == 4 and len({r[0] for r in raw[0]}) == 4
    assert [p[2:] for p in processed[0]] == [("BBC", "One", "best that", "positive", 2)] * 2
    assert sorted(r[2] for r in rejected[0]) == ["u2", "u9"]
    message = json.loads(scraped[0][0][1])
    assert message["content"] == "best that" and message["raw_id"] in {r[0] for r in raw[0]}


def test_dedupe_keeps_the_first_record(spark):
    feed = spark.createDataFrame(
        [("BBC", "new", "u1", 5), ("BBC", "old", "u1", 2), ("BBC", "x", "u2", 1)],
        "source string, title string, url string, position int",
    )
    assert I.raw_articles(feed, "position").count() == 3
    kept = I.raw_articles(feed, "position", dedupe=True)
    assert sorted((r["url"], r["title"]) for r in kept.collect()) == [("u1", "old"), ("u2", "x")]


def test_quality(spark):
    raw = spark.createDataFrame([("1", "s", "t", "u"), ("2", "s", "t", "u")], "id string, source string, title string, url string")
    processed = spark.createDataFrame([("1", "x"), ("1", "y"), ("9", "z")], "raw_article_id string, content string")
    assert [r["id"] for r in Q.unprocessed(raw, processed).collect()] == ["2"]
    assert [r["raw_article_id"] for r in Q.orphans(processed, raw).collect()] == ["9"]
    assert sorted(r["content"] for r in Q.cascade_delete(processed, raw).collect()) == ["x", "y"]
    assert Q.raw_with_processed(raw, processed).count() == 2

    fixed = Q.conform(processed.withColumn("extra", F.lit(1)), S.PROCESSED_ARTICLES)
    assert [(f.name, f.dataType) for f in fixed.schema][:-1] == [(f.name, f.dataType) for f in S.PROCESSED_ARTICLES]
    assert fixed.columns[-1] == "extra"
    bare = {"a": (processed.where("false").select("content"), S.RAW_ARTICLES), "b": (None, S.RAW_ARTICLES)}
    gaps = sorted((r["table_name"], r["column_name"] or "", r["issue"]) for r in Q.schema_gaps(bare).collect())
    assert gaps[-1] == ("b", "", "absent") and len(gaps) == 6 and not Q.is_ready(bare)
    gaps = Q.schema_gaps({"raw_articles": (raw, S.RAW_ARTICLES)}).collect()
    assert sorted((r["column_name"], r["issue"], r["rows"]) for r in gaps) == [
        ("content", "missing", 2), ("received_at", "missing", 2),
    ]
    complete = Q.conform(raw, S.RAW_ARTICLES)
    assert Q.schema_gaps({"raw_articles": (complete, S.RAW_ARTICLES)}).count() == 0

    kinds = spark.createDataFrame([("batch",), ("streaming",), ("other",), (None,)], "processing_type string")
    assert Q.invalid_types(kinds).count() == 2


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    path = new_table_path(spark, "a")
    assert path != new_table_path(spark, "a")
    spark.range(3).write.parquet(path)
    drop_table(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        drop_table(spark, "/tmp/other")


def test_lexicon_table(spark, tmp_path):
    spark.createDataFrame([("Good", 5, "polar")], "word string, score bigint, kind string").write.parquet(str(tmp_path / "l"))
    assert tuple(read_lexicon(spark, str(tmp_path / "l")).collect()[0]) == ("good", 5, "polar")



def test_jdbc_scan_is_cut_into_ranges():
    options = jdbc.scan_options("jdbc:x", "processed_articles", "id", 1, 1000, 8)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
        "id", "1", "1000", "8",
    )


def test_kafka_is_optional(spark):
    if not kafka.has_kafka(spark):
        with pytest.raises(Exception, match="kafka"):
            kafka.stream_kafka(spark, "localhost:9092", ["a"])


def test_scraped_message_layout():
    assert S.SCRAPED_MESSAGE["raw_id"].dataType == T.LongType()
    assert S.scraped_message(T.StringType()).names == S.SCRAPED_MESSAGE.names
