"""One callable per operator over the test tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import schemas as S
from newslens.functions.sentiment import Lexicon, load_lexicon
from newslens.functions.text import preview, word_count
from newslens.functions.times import clock, from_epoch, next_minute, ratio_or_zero, seconds_between
from newslens.operators import extraction as X
from newslens.operators import metrics as M
from newslens.operators import quality as Q
from newslens.operators import sentiment as Sent
from newslens.operators import summaries as Sum
from newslens.operators import timing
from newslens.operators import windows as Win
from newslens.operators import words as W
from newslens.plans import batch_report as B
from newslens.plans import incremental
from newslens.plans import ingest as I
from newslens.session import new_table_path
from newslens.sources import feeds, messages, tables
from newslens.sources.lexicon import sample_lexicon
from newslens.sources.paged import PagedFeed
from newslens.sources.tables import STREAM_START
from newslens.streaming import analytics as A
from newslens.streaming import late_pages as L
from newslens.streaming import partials as P
from newslens.streaming.ingest import start_ingest

Query = Callable[[SparkSession, str], DataFrame]


def start_time() -> Column:
    return F.lit(STREAM_START).cast("timestamp")


def lexicon(spark: SparkSession) -> Lexicon:
    return load_lexicon(sample_lexicon(spark))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with their sentiment, modifiers included."""
    return Sent.with_sentiment(tables.articles(spark, folder), lexicon(spark))


# Words


def article_count(spark, folder):
    return M.article_count(tables.articles(spark, folder))


def word_counts(spark, folder):
    return W.count_words(W.long_words(tables.articles(spark, folder)))


def word_counts_batch(spark, folder):
    return W.count_words(W.all_words(tables.articles(spark, folder)))


def word_counts_stopwords(spark, folder):
    return W.count_words(W.content_words(tables.articles(spark, folder)))


def top_words(spark, folder):
    return W.top_words(word_counts(spark, folder), W.STREAM_TOP)


def top_words_batch(spark, folder):
    return W.top_words(word_counts_batch(spark, folder), W.BATCH_TOP)


def word_count_per_article(spark, folder):
    return tables.articles(spark, folder).select(
        "raw_id", word_count(F.col("content")).alias("word_count")
    )


def article_preview(spark, folder):
    articles = tables.articles(spark, folder)
    return articles.select("raw_id", preview(F.col("content")).alias("preview"))


def top_words_overall(spark, folder):
    """Exact overall ranking of all windows: from full counts, not from cut rankings."""
    return W.top_words(word_counts(spark, folder), W.STREAM_TOP)


# Sentiment


def sentiment_lexicon(spark, folder):
    articles = tables.articles(spark, folder)
    return Sent.with_sentiment(articles, lexicon(spark), modifiers=False).select(
        "raw_id", "sentiment"
    )


def sentiment_negation(spark, folder):
    return scored(spark, folder).select("raw_id", "sentiment")


def sentiment_threshold(spark, folder):
    articles = tables.articles(spark, folder)
    return Sent.with_sentiment(articles, lexicon(spark), threshold=100).select(
        "raw_id", "sentiment"
    )


def sentiment_lexicon_join(spark, folder):
    """The way taken for a lexicon too large for the plan."""
    articles = tables.articles(spark, folder).select("raw_id", "content")
    return Sent.join_sentiment(articles, sample_lexicon(spark)).select("raw_id", "sentiment")


def sentiment_custom_scorer(spark, folder):
    """A caller's scorer over Arrow batches: here, exclamation against question marks."""

    def more_exclaimed(texts: pd.Series) -> pd.Series:
        return (texts.str.count("!") - texts.str.count(r"\?")).astype("float64")

    return Sent.with_custom_sentiment(tables.articles(spark, folder), more_exclaimed).select(
        "raw_id", "sentiment"
    )


def sentiment_without_text(spark, folder):
    """Labels of articles of which some have a null, some an empty text."""
    part = F.pmod("raw_id", F.lit(5))
    content = F.when(part == 1, "").when(part != 0, F.col("content"))
    articles = tables.articles(spark, folder).withColumn("content", content)
    return Sent.with_sentiment(articles, lexicon(spark)).select("raw_id", "sentiment")


def sentiment_distribution(spark, folder):
    return M.sentiment_distribution(scored(spark, folder))


def sentiment_share(spark, folder):
    return M.with_share(sentiment_distribution(spark, folder))


# Sources and reports


def source_statistics(spark, folder):
    return M.source_statistics(tables.articles(spark, folder))


def source_avg_length(spark, folder):
    return M.with_average_length(source_statistics(spark, folder)).select("source", "avg_length")


def metrics_one_scan(spark, folder):
    return M.sentiment_and_sources(scored(spark, folder))


def batch_report(spark, folder):
    return B.batch_report(scored(spark, folder))


def batch_metric_rows(spark, folder):
    return B.batch_metric_rows(scored(spark, folder), start_time()).drop("id")


def batch_report_incremental(spark, folder):
    """The batch report of a table that landed in two slices, each counted when it came."""
    articles, store = new_table_path(spark, "growing"), new_table_path(spark, "counts")
    lex = lexicon(spark)
    every = tables.articles(spark, folder)
    for half in (0, 1):
        every.where(F.pmod("raw_id", F.lit(2)) == half).write.mode("append").parquet(articles)
        incremental.take_slice(spark, articles, store, lambda new: Sent.with_sentiment(new, lex))
    return incremental.stored_report(spark, store)


def scan_processed(spark, folder):
    return tables.processed_articles(tables.articles(spark, folder))


# Windows and roll-ups


def tumbling_counts(spark, folder):
    return Win.tumbling_counts(tables.events(spark, folder), "ts")


def top_words_per_window(spark, folder):
    framed = Win.with_window(tables.articles(spark, folder))
    counts = W.count_words(W.long_words(framed, ["window_start"]), ["window_start"])
    return W.top_words_per(counts, ["window_start"], W.STREAM_TOP)


def sentiment_per_window(spark, folder):
    return M.sentiment_distribution(Win.with_window(scored(spark, folder)), ["window_start"])


def source_stats_per_window(spark, folder):
    framed = Win.with_window(tables.articles(spark, folder))
    return M.source_statistics(framed, ["window_start"])


def three_windows(spark, folder):
    """The stream as back-to-back runs of three windows."""
    runs = Win.with_run(scored(spark, folder), start_time())
    return runs.groupBy("run", "window_no", "sentiment").agg(F.count(F.lit(1)).alias("count"))


def window_clock(spark, folder):
    """Windows by the time of day they begin and end at, and back from epoch seconds."""
    counts = Win.tumbling_counts(tables.events(spark, folder), "ts")
    return counts.select(
        from_epoch(F.unix_timestamp("window_start")).alias("window_start"),
        F.concat_ws("-", clock(F.col("window_start")), clock(F.col("window_end"))).alias("label"),
        "count",
    )


def filter_since(spark, folder):
    """Messages from the second run on."""
    begin = start_time() + F.expr("INTERVAL 45 MINUTES")
    return Win.since(tables.articles(spark, folder), begin).select("raw_id", "timestamp")


def next_minutes(spark, folder):
    return tables.events(spark, folder).select(
        "event_id", next_minute(F.col("ts")).alias("next_minute")
    )


def window_rows(spark, folder):
    return B.windowed_metric_rows(scored(spark, folder)).drop("id")


def recent_metrics(spark, folder):
    return M.recent_metrics(window_rows(spark, folder))


def rollup_sentiment(spark, folder):
    return M.with_share(M.rollup_sentiment(window_rows(spark, folder)))


def rollup_words(spark, folder):
    return M.rollup_words(window_rows(spark, folder))


def rollup_top_words(spark, folder):
    return W.top_words(rollup_words(spark, folder), W.STREAM_TOP)


def rollup_sources(spark, folder):
    return M.with_average_length(M.rollup_sources(window_rows(spark, folder)))


# Timing


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run log from the events: each quarter hour a streaming run, each day a batch run."""
    events = tables.events(spark, folder)

    def log(kind: str, length: str) -> DataFrame:
        return (
            events.groupBy(F.window("ts", length))
            .agg(
                F.min("ts").alias("start_time"),
                F.max("ts").alias("end_time"),
                F.count(F.lit(1)).alias("records"),
            )
            .select(F.lit(kind).alias("processing_type"), "start_time", "end_time", "records")
        )

    return log("streaming", "15 minutes").unionByName(log("batch", "1 day"))


def throughput(spark, folder):
    duration = seconds_between(F.col("start_time"), F.col("end_time"))
    by_type = tables.events(spark, folder).groupBy("event_type").agg(
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count(F.lit(1)).alias("records"),
    )
    return by_type.select(
        "event_type",
        duration.alias("seconds"),
        ratio_or_zero(F.col("records"), duration).alias("records_per_second"),
    )


def timing_rows(spark, folder):
    return timing.timing_metrics(runs(spark, folder))


def compare_performance(spark, folder):
    return timing.compare_performance(timing_rows(spark, folder))


# Pages


def page(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(tables.pages(spark, folder))


def page_articles(spark, folder):
    return X.articles(tables.pages(spark, folder)).drop("url")


def extract_accepted(spark, folder):
    return X.accepted(page_articles(spark, folder))


def extract_rejected(spark, folder):
    return X.rejected(page_articles(spark, folder))


def varied_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages, some of them turned into cases that the table does not hold: empty pages,
    hidden blocks, an end marker with text after it, links to videos."""
    html, case = F.col("html"), F.col("page_id") % 6
    hidden = '<article><p style="display: none">unseen words</p>'
    ended = "<p>End of Article</p><p>left out</p></article>"
    return tables.pages(spark, folder).select(
        "page_id",
        F.when(case == 5, F.concat("url", F.lit("/videos/1"))).otherwise(F.col("url")).alias("url"),
        F.when(case == 1, "<html><head></head><body></body></html>")
        .when(case == 2, F.replace(html, F.lit("<article>"), F.lit(hidden)))
        .when(case == 3, F.replace(html, F.lit("</article>"), F.lit(ended)))
        .otherwise(html)
        .alias("html"),
    )


def varied_articles(spark, folder):
    """Blanks are made one: those before an end marker are kept as they are on the page."""
    found = X.articles(varied_pages(spark, folder)).drop("url")
    return found.withColumn("content", F.regexp_replace("content", " +", " "))


def varied_rejected(spark, folder):
    return X.rejected(X.articles(varied_pages(spark, folder)).drop("url"))


def varied_end_marker(spark, folder):
    return X.end_markers(varied_pages(spark, folder))


def varied_hidden(spark, folder):
    return X.removed_counts(varied_pages(spark, folder))


def varied_headings(spark, folder):
    """Titles of pages with headings put before the article, empty ones in between, or after it."""
    html, case, number = F.col("html"), F.col("page_id") % 4, F.col("page_id").cast("string")

    def before(*markup: Column) -> Column:
        return F.replace(html, F.lit("<article>"), F.concat(*markup, F.lit("<article>")))

    pages = tables.pages(spark, folder).select(
        "page_id",
        "url",
        F.when(case == 1, before(F.lit("<h2>Heading &amp; more "), number, F.lit("</h2>")))
        .when(case == 2, before(F.lit("<h1>Old</h1><h3>First "), number, F.lit("</h3><h1></h1>")))
        .when(case == 3, F.replace(html, F.lit("</article>"), F.lit("</article><h1>After</h1>")))
        .otherwise(html)
        .alias("html"),
    )
    return X.articles(pages).select("page_id", "title")


def varied_blocks(spark, folder):
    """Texts of pages whose article is a mere block: what the text ratio chooses."""
    html = F.replace(F.replace("html", F.lit("<article>"), F.lit("<div>")), F.lit("</article>"), F.lit("</div>"))
    pages = tables.pages(spark, folder).where(F.col("page_id") % 3 == 0).withColumn("html", html)
    return X.articles(pages).select("page_id", "content")


def varied_cascade(spark, folder):
    """Pages whose article is a div or a section with a telling class."""
    html, case = F.col("html"), F.col("page_id") % 3

    def turned(tag: str, opening: str) -> Column:
        opened = F.replace(html, F.lit("<article>"), F.lit(opening))
        return F.replace(opened, F.lit("</article>"), F.lit(f"</{tag}>"))

    pages = tables.pages(spark, folder).withColumn(
        "html",
        F.when(case == 0, turned("div", '<div class="story-text">'))
        .when(case == 1, turned("section", "<section class='the main'>"))
        .otherwise(html),
    )
    return X.articles(pages, by_class=True).select("page_id", "title", "content")


def feed_without_results(spark, folder):
    """Feeds of which every third response has no results, next to one without entries."""
    result = F.struct(F.col("title").alias("webTitle"), F.col("url").alias("webUrl"))
    groups = page_feed(spark, folder).groupBy(F.floor(F.col("page_id") / 10).alias("page")).agg(F.collect_list(result).alias("results"))
    response = F.when(F.col("page") % 3 == 0, F.lit("{}")).otherwise(
        F.to_json(F.struct(F.struct("results").alias("response")))
    )
    path, empty = new_table_path(spark, "api"), new_table_path(spark, "rss")
    groups.select(response.alias("value")).write.text(path)
    page_feed(spark, folder).where("false").select("title", F.col("url").alias("link")).write.format("xml").option(
        "rowTag", "item"
    ).option("rootTag", "channel").save(empty)
    return messages.merge(
        feeds.read_api(spark, path, "Guardian", one_per_file=False), feeds.read_rss(spark, empty, "BBC")
    )


def varied_links(spark, folder):
    pages = X.with_title(varied_pages(spark, folder))
    feed = pages.select(source_of(F.col("url")).alias("source"), "title", "url")
    return feeds.without_videos(feed).select("title", "url")


# Feeds and messages


def source_of(url: Column) -> Column:
    """Test pages belong to three publishers by the end of their host name."""
    ending = F.regexp_extract(url, r"^https?://[^/]*\.([a-z]+)(?:[/?#]|$)", 1)
    return F.when(ending == "com", "BBC").when(ending == "net", "Guardian").otherwise("Reuters")


def page_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed records that announce the pages: (page_id, source, title, url)."""
    return X.with_title(tables.pages(spark, folder)).select(
        "page_id", source_of(F.col("url")).alias("source"), "title", "url"
    )


def landed_rss(feed: DataFrame) -> str:
    """Land the feed as RSS files, return where."""
    path = new_table_path(feed.sparkSession, "rss")
    items = feed.select("title", F.col("url").alias("link"))
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    return path


def landed_api(feed: DataFrame, page_size: int = 10) -> str:
    """Land the feed as API responses of ``page_size`` results, return where."""
    path = new_table_path(feed.sparkSession, "api")
    result = F.struct(F.col("title").alias("webTitle"), F.col("url").alias("webUrl"))
    responses = (
        feed.groupBy(F.floor(F.col("page_id") / page_size).alias("page"))
        .agg(F.collect_list(result).alias("results"))
        .select(F.struct("results").alias("response"))
    )
    responses.write.json(path)
    return path


def feed_rss(spark, folder):
    return feeds.read_rss(spark, landed_rss(page_feed(spark, folder)), "BBC")


def feed_json_api(spark, folder):
    path = landed_api(page_feed(spark, folder))
    return feeds.read_api(spark, path, "Guardian", one_per_file=False)


def feed_stream_paged(spark, folder):
    """An API read page by page as a stream: half of the pages first, the rest after a restart."""
    spark.dataSource.register(PagedFeed)
    result = F.struct(F.col("title").alias("webTitle"), F.col("url").alias("webUrl"))
    pages = page_feed(spark, folder).groupBy((F.floor(F.col("page_id") / 10) + 1).alias("page")).agg(
        F.collect_list(result).alias("results")
    ).select("page", F.struct("results").alias("response"))
    landed, out, progress = (new_table_path(spark, n) for n in ("pages", "feed", "checkpoint"))
    half = tables.pages(spark, folder).agg(F.max("page_id")).first()[0] // 20 + 1
    for some in (F.col("page") <= half, F.col("page") > half):
        pages.where(some).write.mode("append").partitionBy("page").json(landed)
        (
            spark.readStream.format("paged_feed").option("source", "Guardian").load(landed).drop("page")
            .writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
            .trigger(**ONCE).start().awaitTermination()
        )
    return spark.read.schema("source string, title string, url string").parquet(out)


def filter_links(spark, folder):
    return feeds.without_videos(page_feed(spark, folder)).select("title", "url")


def route_topics(spark, folder):
    return messages.route(page_feed(spark, folder), "page_id")


def merge_topics(spark, folder):
    """Three topics, each written by its own feed, read as one."""
    feed = page_feed(spark, folder)
    path = new_table_path(spark, "topics")
    messages.write_topics(messages.route(feed), path)
    return messages.read_topics(spark, path, *S.FEED_TOPICS.values()).select("topic", "value")


def encode_messages(spark, folder):
    return messages.encode(tables.articles(spark, folder), S.SCRAPED_MESSAGE, "raw_id")


def article_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The article stream as messages: (topic, value, timestamp)."""
    articles = tables.articles(spark, folder)
    encoded = messages.encode(articles, S.SCRAPED_MESSAGE, "timestamp")
    return encoded.select(F.lit(S.SCRAPED_TOPIC).alias("topic"), "value", "timestamp")


def decode_messages(spark, folder):
    return messages.decode(article_messages(spark, folder), S.SCRAPED_MESSAGE)


def parse_envelope(spark, folder):
    return messages.parse_envelope(article_messages(spark, folder))


# Ingest


def raw_articles(spark, folder):
    return I.raw_articles(page_feed(spark, folder), "page_id")


def ingested(spark: SparkSession, folder: str) -> I.Ingested:
    return I.ingest(page_feed(spark, folder), tables.pages(spark, folder), lexicon(spark), "page_id")


def processed_articles(spark, folder):
    return ingested(spark, folder).processed


def scraped_messages(spark, folder):
    return ingested(spark, folder).messages


# Links and checks: documents are the articles, labels those that were looked at.


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    return tables.articles(spark, folder).select(
        F.col("raw_id").alias("id"),
        "source",
        "title",
        F.concat(F.lit("doc:"), F.col("raw_id")).alias("url"),
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_table(spark, folder, "labels").withColumnRenamed("doc_id", "raw_article_id")


def raw_with_processed(spark, folder):
    return Q.raw_with_processed(raw_documents(spark, folder), labelled(spark, folder))


def unprocessed_raw(spark, folder):
    return Q.unprocessed(raw_documents(spark, folder), labelled(spark, folder))


def linked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All documents as processed articles, the labelled ones as raw articles left."""
    processed = raw_documents(spark, folder).withColumnRenamed("id", "raw_article_id")
    return processed, labelled(spark, folder).withColumnRenamed("raw_article_id", "id")


def fk_orphans(spark, folder):
    return Q.orphans(*linked(spark, folder))


def cascade_delete(spark, folder):
    return Q.cascade_delete(*linked(spark, folder))


def conform_schema(spark, folder):
    articles = tables.articles(spark, folder).withColumnRenamed(
        "raw_id", "raw_article_id"
    )
    return Q.conform(articles, S.PROCESSED_ARTICLES)


def schema_gaps(spark, folder):
    articles = tables.articles(spark, folder)
    processed = articles.select(
        F.col("raw_id").cast("string").alias("id"),
        F.col("raw_id").alias("raw_article_id"),
        "source",
        F.when(F.col("title") != F.col("content"), F.col("title")).alias("title"),
        "content",
        word_count(F.col("content")).alias("word_count"),
    )
    return Q.schema_gaps(
        {
            "raw_articles": (raw_articles(spark, folder), S.RAW_ARTICLES),
            "processed_articles": (processed, S.PROCESSED_ARTICLES),
            "new_articles": (processed.where("false").select("id", "source"), S.PROCESSED_ARTICLES),
            "analytics_results": (None, S.ANALYTICS_RESULTS),
        },
        spark,
    )


# Streams: run over landed message files until all of them are read.

ONCE = {"availableNow": True}


def landed_messages(spark: SparkSession, folder: str) -> DataFrame:
    path = new_table_path(spark, "messages")
    messages.write_topics(article_messages(spark, folder), path)
    return messages.stream_topics(spark, path, S.SCRAPED_TOPIC)


def stream_ingest(spark, folder):
    stream = A.scored_stream(landed_messages(spark, folder), lexicon(spark))
    rows = stream.withColumn("word_count", word_count(F.col("content"))).drop("title", "content")
    rows = rows.withColumn("raw_id", F.col("raw_id").cast("bigint"))
    path = new_table_path(spark, "scored")
    A.start_scoring(rows, path, new_table_path(spark, "checkpoint"), ONCE).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def streamed_results(
    spark: SparkSession, folder: str, start: Column | None = None, messages: DataFrame | None = None
) -> DataFrame:
    """Stored rows of all windows of a stream that has ended, or of one run from ``start``."""
    stream = landed_messages(spark, folder) if messages is None else messages
    path, partials, progress = (new_table_path(spark, n) for n in ("analytics", "partials", "checkpoint"))
    query = P.start_partial_analytics(
        A.scored_stream(stream, lexicon(spark)), path, partials, progress, ONCE, start=start
    )
    query.awaitTermination()
    P.write_open_windows(spark, query, path, partials)
    return stored_rows(spark, path)


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of each window and metric, without the summaries of words."""
    results = M.latest(spark.read.schema(S.ANALYTICS_RESULTS).parquet(path))
    return results.where(F.col("metric_name") != Sum.SUMMARY)


def stream_three_windows(spark, folder):
    """Metric rows of a bounded run: the three windows from 01:00 on, and no other."""
    results = streamed_results(spark, folder, start_time() + F.expr("INTERVAL 1 HOUR"))
    return results.select("window_start", "window_end", "metric_name", "metric_value")


def stream_from_ingest(spark, folder):
    """Sentiments of all articles that the ingest job published and the stream read back."""
    feed = page_feed(spark, folder)
    out, topics = new_table_path(spark, "tables"), new_table_path(spark, "feeds")
    messages.write_topics(messages.route(feed).withColumn("timestamp", start_time()), topics)
    landed = messages.stream_topics(spark, topics, *S.FEED_TOPICS.values())
    progress = new_table_path(spark, "checkpoint")
    pages_path = f"{folder}/pages.parquet"
    start_ingest(landed, pages_path, lexicon(spark), out, progress, ONCE).awaitTermination()
    published = messages.stream_topics(spark, f"{out}/topics", S.SCRAPED_TOPIC)
    results = streamed_results(spark, folder, messages=published)
    moods = M.metric_items(results, M.SENTIMENTS, M.SENTIMENT_ITEMS, ["window_start"])
    return moods.groupBy("sentiment").agg(F.sum("count").alias("count"))


def land(rows: DataFrame, path: str, form: str) -> None:
    """The rows as files of as many tasks as hold them. A job that is run after each landing
    takes them as one batch, however many files they are."""
    rows.write.mode("append").format(form).save(path)


def landed_parts(rows: DataFrame, part: Column, parts: int, path: str) -> Iterator[int]:
    """Messages part by part: each number is given out when its messages have landed."""
    numbered = rows.withColumn("_part", part)
    for i in range(parts):
        land(numbered.where(F.col("_part") == i).drop("_part"), path, "json")
        yield i


def page_days(spark: SparkSession, folder: str) -> int:
    """Days that the feed of all pages lasts, one a minute by page number."""
    last = tables.pages(spark, folder).agg(F.max("page_id")).first()[0]
    return (last or 0) // (24 * 60) + 2


def sent_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed messages, one a minute by page number, with the number as their key."""
    feed = page_feed(spark, folder)
    minutes = F.make_dt_interval(mins=F.col("page_id").cast("int"))
    return messages.route(
        feed.withColumn("timestamp", start_time() + minutes).withColumn("key", F.col("page_id").cast("string")),
        "timestamp", "key",
    )


def stream_late_pages(spark, folder):
    """What became of each feed record: a third of the pages is crawled 20 minutes after its
    record and lands in a later batch, a fifth is never crawled, a seventh is crawled twice."""
    number = F.col("page_id").cast("int")
    late = number % 3 == 0
    minutes = F.make_dt_interval(mins=number + F.when(late, 20).otherwise(0))
    pages = tables.pages(spark, folder).where(number % 5 != 4).select(
        "page_id", "url", "html", (start_time() + minutes).alias("crawled_at")
    )
    again = pages.where(number % 7 == 0).withColumn("crawled_at", F.col("crawled_at") + F.expr("INTERVAL 2 MINUTES"))
    # Files of one batch hold days of messages here; the lateness covers the whole table.
    days = page_days(spark, folder)
    # Something that lands long after, so that what still waits is given up. The page has a
    # url, because one without is left out before the watermark sees it.
    end = spark.range(1).select((start_time() + F.make_dt_interval(days=F.lit(3 * days))).alias("end"))
    last_page = end.select(F.lit("end").alias("url"), F.lit("").alias("html"), F.col("end").alias("crawled_at"))
    last_record = end.select(
        F.lit(S.FEED_TOPICS["BBC"]).alias("topic"), F.lit("{}").alias("value"),
        F.col("end").alias("timestamp"), F.lit("end").alias("key"),
    )
    every, record = pages.unionByName(again), sent_feed(spark, folder)
    crawled, topics, out, progress = (new_table_path(spark, n) for n in ("crawled", "feeds", "tables", "checkpoint"))
    lex = lexicon(spark)
    for new_pages, new_records in (
        (every.where(~late).drop("page_id"), record), (every.where(late).drop("page_id"), None), (last_page, last_record)
    ):
        land(new_pages, crawled, "parquet")
        if new_records is not None:
            land(new_records, topics, "json")
        L.start_waiting_ingest(
            L.feed_records(messages.stream_topics(spark, topics), lateness=f"{days} days"),
            L.crawled_pages(spark, crawled), lex, out, progress, ONCE, lateness=f"{days} days",
        ).awaitTermination()
    done = spark.read.parquet(f"{out}/processed").select("raw_article_id", "source", F.lit("processed").alias("outcome"), "word_count")
    gone = spark.read.parquet(f"{out}/rejected").where("url IS NOT NULL").select(
        "raw_article_id", "source", F.lit("rejected").alias("outcome"), F.lit(None).cast("int").alias("word_count")
    )
    return done.unionByName(gone)


def stream_distinct_articles(spark, folder):
    """Records of a feed that is polled three times, each time after a restart."""
    feed = sent_feed(spark, folder).withColumn("poll", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    shift = F.make_dt_interval(mins=F.col("poll") * 10)
    feed = feed.withColumn("timestamp", F.col("timestamp") + shift).withColumn("key", F.concat_ws("-", "key", "poll"))
    topics, out, progress = (new_table_path(spark, n) for n in ("feeds", "distinct", "checkpoint"))
    lateness = f"{page_days(spark, folder)} days"
    for _ in landed_parts(feed, F.col("poll"), 3, topics):
        records = L.distinct_records(L.feed_records(messages.stream_topics(spark, topics), lateness=lateness))
        (
            records.select("source", "title", "url")
            .writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
            .trigger(**ONCE).start().awaitTermination()
        )
    return spark.read.schema("source string, title string, url string").parquet(out)


def stream_metric_rows(spark, folder):
    return streamed_results(spark, folder).select(
        "window_start", "window_end", "metric_name", "metric_value", "processing_type"
    )


def partial_stream(spark: SparkSession, folder: str, parts: int = 3) -> tuple[DataFrame, str]:
    """Metric rows of a stream of several batches in order of time, and its folder of partial counts."""
    sent = article_messages(spark, folder)
    first, last = (sent.agg(f("timestamp")).first()[0] for f in (F.min, F.max))
    share = F.unix_micros("timestamp") - F.unix_micros(F.lit(first))
    length = F.unix_micros(F.lit(last)) - F.unix_micros(F.lit(first)) + 1
    topics, path, partials, progress = (new_table_path(spark, n) for n in ("messages", "analytics", "partials", "checkpoint"))
    lex = lexicon(spark)
    for _ in landed_parts(sent.withColumn("key", F.lit("")), F.floor(share * parts / length), parts, topics):
        landed = messages.stream_topics(spark, topics, S.SCRAPED_TOPIC)
        query = P.start_partial_analytics(A.scored_stream(landed, lex), path, partials, progress, ONCE)
        query.awaitTermination()
    P.write_open_windows(spark, query, path, partials)
    return stored_rows(spark, path), partials


def stream_metric_rows_partial(spark, folder):
    """The rows of ``stream_metric_rows`` from partial counts; no state holds words."""
    results, _ = partial_stream(spark, folder)
    return results.select(
        "window_start", "window_end", "metric_name", "metric_value", "processing_type"
    )


def stream_late_counts(spark, folder):
    """Messages per window that came after it was closed: of the first third every eleventh
    message lands with the last third."""
    sent = article_messages(spark, folder)
    last = sent.agg(F.max("timestamp")).first()[0]
    third = (F.unix_micros(F.lit(last)) - F.unix_micros(start_time())) / 3
    at = (F.unix_micros("timestamp") - F.unix_micros(start_time())) / third
    held_back = (at < 1) & (F.pmod(F.unix_micros("timestamp"), F.lit(660_000_000)) == 0)
    part = F.when(held_back, 2).when(at < 1, 0).when(at < 2, 1).otherwise(2)
    topics, path, partials, progress = (new_table_path(spark, n) for n in ("messages", "analytics", "partials", "checkpoint"))
    lex = lexicon(spark)
    for _ in landed_parts(sent.withColumn("key", F.lit("")), part, 3, topics):
        landed = A.parsed_stream(messages.stream_topics(spark, topics, S.SCRAPED_TOPIC))
        P.start_partial_analytics(
            landed, path, partials, progress, ONCE, score=lambda new: A.scored_batch(new, lex)
        ).awaitTermination()
    return P.late_counts(spark, partials)


def rollup_top_words_exact(spark, folder):
    """The exact overall ranking from short summaries of windows; undecided words are counted."""
    framed = Win.with_window(tables.articles(spark, folder))
    window = ["window_start", "window_end"]
    counts = W.count_words(W.long_words(framed, window), window)
    path = new_table_path(spark, "summaries")
    Sum.summary_rows(Sum.summarise(counts, window, 20), "streaming").write.parquet(path)
    stored = spark.read.parquet(path)
    words = W.long_words(tables.articles(spark, folder)).withColumn("count", F.lit(1).cast("bigint"))
    return Sum.exact_top_words(Sum.stored_summaries(stored), words, W.STREAM_TOP)


def stream_report(spark, folder):
    """The stored rows of a stream read back into long form."""
    results = streamed_results(spark, folder)
    words = M.metric_items(results, M.WORDS, M.WORD_ITEMS, ["window_start", "metric_name"])
    moods = M.metric_items(results, M.SENTIMENTS, M.SENTIMENT_ITEMS, ["window_start", "metric_name"])
    sources = M.metric_items(results, M.SOURCES, M.SOURCE_ITEMS, ["window_start", "metric_name"])
    nothing = F.lit(None).cast("bigint").alias("total_length")
    return (
        words.withColumnRenamed("word", "key")
        .select("*", nothing)
        .unionByName(moods.withColumnRenamed("sentiment", "key").select("*", nothing))
        .unionByName(sources.withColumnRenamed("source", "key"))
    )


QUERIES: dict[str, Query] = {
    "article_count": article_count,
    "article_preview": article_preview,
    "batch_metric_rows": batch_metric_rows,
    "batch_report": batch_report,
    "batch_report_incremental": batch_report_incremental,
    "cascade_delete": cascade_delete,
    "compare_performance": compare_performance,
    "conform_schema": conform_schema,
    "decode_messages": decode_messages,
    "encode_messages": encode_messages,
    "extract_accepted": extract_accepted,
    "extract_rejected": extract_rejected,
    "feed_json_api": feed_json_api,
    "feed_rss": feed_rss,
    "feed_stream_paged": feed_stream_paged,
    "feed_without_results": feed_without_results,
    "filter_links": filter_links,
    "filter_since": filter_since,
    "fk_orphans": fk_orphans,
    "merge_topics": merge_topics,
    "metrics_one_scan": metrics_one_scan,
    "next_minute": next_minutes,
    "page_articles": page_articles,
    "page_clean_text": page(X.clean_text),
    "page_end_marker": page(X.end_markers),
    "page_hidden_removed": page(X.removed_counts),
    "page_tag_events": page(X.tag_events),
    "page_text_blocks": page(X.text_blocks),
    "page_titles": page(X.titles),
    "parse_envelope": parse_envelope,
    "processed_articles": processed_articles,
    "raw_articles": raw_articles,
    "raw_with_processed": raw_with_processed,
    "recent_metrics": recent_metrics,
    "rollup_sentiment": rollup_sentiment,
    "rollup_sources": rollup_sources,
    "rollup_top_words": rollup_top_words,
    "rollup_top_words_exact": rollup_top_words_exact,
    "rollup_words": rollup_words,
    "route_topics": route_topics,
    "scan_processed": scan_processed,
    "schema_gaps": schema_gaps,
    "scraped_messages": scraped_messages,
    "sentiment_custom_scorer": sentiment_custom_scorer,
    "sentiment_distribution": sentiment_distribution,
    "sentiment_lexicon": sentiment_lexicon,
    "sentiment_lexicon_join": sentiment_lexicon_join,
    "sentiment_negation": sentiment_negation,
    "sentiment_per_window": sentiment_per_window,
    "sentiment_share": sentiment_share,
    "sentiment_threshold": sentiment_threshold,
    "sentiment_without_text": sentiment_without_text,
    "source_avg_length": source_avg_length,
    "source_statistics": source_statistics,
    "source_stats_per_window": source_stats_per_window,
    "stream_distinct_articles": stream_distinct_articles,
    "stream_from_ingest": stream_from_ingest,
    "stream_ingest": stream_ingest,
    "stream_late_pages": stream_late_pages,
    "stream_late_counts": stream_late_counts,
    "stream_metric_rows": stream_metric_rows,
    "stream_metric_rows_partial": stream_metric_rows_partial,
    "stream_report": stream_report,
    "stream_three_windows": stream_three_windows,
    "three_windows": three_windows,
    "throughput": throughput,
    "timing_metrics": timing_rows,
    "top_words": top_words,
    "top_words_batch": top_words_batch,
    "top_words_overall": top_words_overall,
    "top_words_per_window": top_words_per_window,
    "tumbling_counts": tumbling_counts,
    "unprocessed_raw": unprocessed_raw,
    "varied_articles": varied_articles,
    "varied_blocks": varied_blocks,
    "varied_cascade": varied_cascade,
    "varied_end_marker": varied_end_marker,
    "varied_headings": varied_headings,
    "varied_hidden": varied_hidden,
    "varied_links": varied_links,
    "varied_rejected": varied_rejected,
    "window_clock": window_clock,
    "word_count": word_count_per_article,
    "word_counts": word_counts,
    "word_counts_batch": word_counts_batch,
    "word_counts_stopwords": word_counts_stopwords,
}
