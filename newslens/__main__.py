"""Run the jobs: python -m newslens <job> --help, or spark-submit this file."""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import schemas as S
from newslens.functions.times import RUN_WINDOWS, WINDOW_MINUTES
from newslens.operators import metrics as M
from newslens.operators import quality as Q
from newslens.operators import summaries as Sum
from newslens.operators import words as W
from newslens.operators.sentiment import labeller, score_articles
from newslens.operators.timing import compare_performance
from newslens.plans import batch_report as B
from newslens.plans import incremental
from newslens.session import build_session
from newslens.sources import feeds, kafka, messages
from newslens.sources.lexicon import read_lexicon
from newslens.streaming import analytics as A
from newslens.streaming import late_pages, partials
from newslens.streaming.ingest import start_ingest
from newslens.streaming.progress import observed


def parse_args(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="newslens")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, **paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        for path, meaning in paths.items():
            sub.add_argument(f"--{path}", required=True, help=meaning)
        return sub

    def stream(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--servers", help="Kafka servers; without them --topics is a folder")
        sub.add_argument("--topics", help="folder of landed messages")
        sub.add_argument("--once", action="store_true", help="stop when all input is read")

    sub = job("publish", "landed feeds to topics", out="folder of topic messages")
    sub.add_argument("--rss", action="append", default=[], metavar="SOURCE=PATH")
    sub.add_argument("--api", action="append", default=[], metavar="SOURCE=PATH")
    sub = job(
        "ingest", "feed topics and crawled pages to article tables",
        pages="table (url, html), with crawled_at if records wait", lexicon="table (word, score, kind)",
        out="folder of the article tables", checkpoint="folder of the stream's progress",
    )
    stream(sub)
    sub.add_argument("--wait", help="how long a record waits for a page that is not there yet, as in '1 hour'")
    sub.add_argument("--distinct", help="suppress records that repeat one of this time before, as in '1 hour'")
    sub = job(
        "stream", "scraped messages to windowed metrics",
        lexicon="table (word, score, kind)", metrics="table of metric rows",
        checkpoint="folder of the stream's progress",
    )
    stream(sub)
    sub.add_argument("--start", type=datetime.fromisoformat, help="count one run from this time on")
    sub.add_argument("--windows", type=int, default=RUN_WINDOWS)
    sub.add_argument("--timing", help="table of run times")
    sub.add_argument("--lateness", default=A.LATENESS, help="how late a message may be")
    sub.add_argument("--partials", help="folder of partial counts, next to the metrics if not given")
    sub = job(
        "batch", "all processed articles to metrics",
        articles="table (raw_article_id, source, title, content)",
        lexicon="table (word, score, kind)", metrics="table of metric rows",
        timing="table of run times",
    )
    sub.add_argument("--store", help="folder of counts: read only files that came since the last run with it")
    sub = job("summary", "roll-up of stored stream metrics", metrics="table of metric rows")
    sub.add_argument("--partials", help="folder of partial counts, next to the metrics if not given")
    sub.add_argument("--start", type=datetime.fromisoformat, help="only the run from this time on")
    sub.add_argument("--windows", type=int, default=RUN_WINDOWS)
    job("compare", "batch against streaming run times", timing="table of run times")
    sub = jobs.add_parser("check", help="whether the tables are complete")
    for name in S.TABLES:
        sub.add_argument(f"--{name}", help=f"the {name} table")
    return parser.parse_args(argv)


def utc(time: datetime) -> datetime:
    return time if time.tzinfo else time.replace(tzinfo=timezone.utc)


def publish(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    read = [feeds.read_rss(spark, path, source) for source, path in pairs(args.rss)]
    read += [feeds.read_api(spark, path, source) for source, path in pairs(args.api)]
    if not read:
        raise SystemExit("publish needs --rss or --api")
    feed = feeds.without_videos(messages.merge(*read), feeds.VIDEO_SOURCE)
    routed = messages.route(feed)
    messages.write_topics(routed.withColumn("timestamp", F.current_timestamp()), args.out)
    return []


def pairs(options: list[str]) -> list[tuple[str, str]]:
    return [tuple(option.split("=", 1)) for option in options]


def incoming(spark: SparkSession, args: argparse.Namespace, starting: str, *topics: str) -> DataFrame:
    if args.servers:
        return kafka.stream_kafka(spark, args.servers, topics, starting)
    return messages.stream_topics(spark, args.topics, *topics)


def trigger(args: argparse.Namespace) -> dict[str, bool] | None:
    return {"availableNow": True} if args.once else None


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    lexicon = labeller(read_lexicon(spark, args.lexicon))
    feed = incoming(spark, args, "earliest", *S.FEED_TOPICS.values())
    publish = (lambda rows: kafka.write_kafka(rows, args.servers)) if args.servers else None
    position = "position" if args.servers else "key"
    if args.distinct:
        feed = late_pages.distinct_messages(feed, position, args.distinct)
    if args.wait:
        records = late_pages.feed_records(feed, position, None if args.distinct else late_pages.LATENESS)
        query = late_pages.start_waiting_ingest(
            records, late_pages.crawled_pages(spark, args.pages), lexicon, args.out, args.checkpoint,
            trigger(args), wait=args.wait, publish=publish,
        )
    else:
        query = start_ingest(
            feed, args.pages, lexicon, args.out, args.checkpoint, trigger(args), position=position, publish=publish
        )
    query.awaitTermination()
    return []


def partials_of(args: argparse.Namespace) -> str:
    return args.partials or f"{args.metrics.rstrip('/')}-partials"


def run_stream(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    lexicon = labeller(read_lexicon(spark, args.lexicon))
    read = observed(A.parsed_stream(incoming(spark, args, "latest", S.SCRAPED_TOPIC)))
    start = utc(args.start) if args.start else None
    query = partials.start_partial_analytics(
        read, args.metrics, partials_of(args), args.checkpoint, trigger(args), args.lateness,
        start=start, windows=args.windows, timing_path=args.timing, score=lambda new: A.scored_batch(new, lexicon),
    )
    if start and not args.once:
        A.await_windows(query, start + timedelta(minutes=WINDOW_MINUTES * args.windows))
    else:
        query.awaitTermination()
    if args.once:
        partials.write_open_windows(spark, query, args.metrics, partials_of(args), timing_path=args.timing)
    return []


def run_batch(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    lexicon = read_lexicon(spark, args.lexicon)

    def score(articles: DataFrame) -> DataFrame:
        return score_articles(articles.drop("sentiment"), lexicon, key="raw_article_id")

    if args.store:
        return [incremental.run_incremental(spark, args.articles, args.store, score, args.metrics, args.timing)]
    return [B.run_batch(score(spark.read.parquet(args.articles)), args.metrics, args.timing)]


def summary(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """Shares of sentiments, the most frequent words and the sources of all stored windows.

    The ranking is exact: most words are decided by the summaries of the windows, the others
    are counted from the stored counts. Metric rows without summaries are rolled up.
    """
    results = M.latest(spark.read.parquet(args.metrics)).where(F.col("processing_type") == "streaming")
    counts = partials.all_counts(spark, partials_of(args)).where(F.col("metric_name") == M.WORDS)
    if args.start:
        results = M.of_run(results, utc(args.start), args.windows)
        counts = M.of_run(counts, utc(args.start), args.windows)
    if counts.isEmpty():
        words = W.top_words(M.rollup_words(results), W.STREAM_TOP)
    else:
        words = Sum.exact_top_words(
            Sum.stored_summaries(results), counts.select(F.col("key").alias("word"), "count"), W.STREAM_TOP
        )
    return [
        M.with_share(M.rollup_sentiment(results)),
        words,
        M.with_average_length(M.rollup_sources(results)),
    ]


def compare(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    return [compare_performance(spark.read.parquet(args.timing))]


def check(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    def table(path: str | None) -> DataFrame | None:
        try:
            return spark.read.parquet(path) if path else None
        except AnalysisException:  # no such path, or nothing in it
            return None

    return [Q.schema_gaps({n: (table(getattr(args, n)), S.TABLES[n]) for n in S.TABLES}, spark)]


JOBS = {
    "publish": publish,
    "ingest": run_ingest,
    "stream": run_stream,
    "batch": run_batch,
    "summary": summary,
    "compare": compare,
    "check": check,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[DataFrame]:
    args = parse_args(argv)
    answers = JOBS[args.job](spark or build_session(f"newslens {args.job}"), args)
    for answer in answers:
        print(*answer.columns, sep="\t")
        for row in answer.toLocalIterator():
            print(*row, sep="\t")
    return answers


if __name__ == "__main__":
    main()
