"""How the registered streams work: no words as state, no part of a table in one task."""

import glob
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from newslens.plans import registry as R
from newslens.sources import paged
from newslens.streaming import partials as P

from test_streaming import T0

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def written(spark, tmp_path, monkeypatch):
    """Where the queries write: a folder of this test."""
    monkeypatch.setattr(R, "new_table_path", lambda _, name: f"{tmp_path}/out/{name}-{len(glob.glob(f'{tmp_path}/out/{name}-*'))}")
    return f"{tmp_path}/out"


@pytest.fixture
def dealt(spark, tmp_path):
    """Tables of four files each."""
    for name in ("documents", "pages"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(4).write.parquet(f"{tmp_path}/in/{name}.parquet")
    return f"{tmp_path}/in"


@pytest.mark.parametrize("query", [R.stream_metric_rows, R.stream_report])
def test_no_words_as_state(spark, written, query):
    assert query(spark, FOLDER).count() > 40
    assert glob.glob(f"{written}/checkpoint-*/offsets/*")
    assert glob.glob(f"{written}/checkpoint-*/state/*/*") == []


def test_files_of_counts_do_not_grow_with_dates_times_tasks(spark, tmp_path, monkeypatch):
    """Each date is written by few tasks."""
    monkeypatch.setattr(P, "stream_id", lambda batch: "one")
    rows = [("s", "neutral", f"some words about number{i % 26}x", T0 + timedelta(hours=i)) for i in range(24 * 20)]
    batch = spark.createDataFrame(rows, "source string, sentiment string, content string, timestamp timestamp")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        P.partial_writer(f"{tmp_path}/out", f"{tmp_path}/partials")(batch, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name in ("open", "counts"):
        files = glob.glob(f"{tmp_path}/partials/{name}/window_date=*/*/*/part-*")
        assert len(files) <= 25, name


@pytest.mark.parametrize(
    ("query", "landed", "parts"),
    [
        (R.stream_late_counts, "messages", 3),
        (R.stream_metric_rows_partial, "messages", 3),
        (R.stream_late_pages, "crawled", 3),
        (R.stream_late_pages, "feeds", 2),
        (R.stream_distinct_articles, "feeds", 3),
    ],
)
def test_tables_land_from_all_tasks(spark, written, dealt, query, landed, parts):
    """More files than parts that land: a part is not written by a single task."""
    assert query(spark, dealt).count() > 0
    assert len(glob.glob(f"{written}/{landed}-*/part-*")) > parts


def test_lateness_covers_the_pages(spark, tmp_path):
    """A feed that lasts longer than any fixed number of days loses no record."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    far = pages.withColumn("page_id", F.col("page_id") + 3 * 1_000_000 * (F.col("page_id") % 2)).withColumn(
        "url", F.concat("url", F.lit("?n="), F.col("page_id"))
    )
    far.write.parquet(f"{tmp_path}/pages.parquet")
    rows = R.stream_late_pages(spark, str(tmp_path)).collect()
    assert len(rows) == pages.count()
    crawled = far.where(F.col("page_id") % 5 != 4).count()
    assert sum(r["outcome"] == "processed" for r in rows) == crawled


def test_many_pages_in_few_partitions():
    few, many = paged.runs(range(1, 4)), paged.runs(range(1, 10_001))
    assert [list(p.numbers) for p in few] == [[1], [2], [3]]
    assert len(many) <= paged.PARTS and [n for p in many for n in p.numbers] == list(range(1, 10_001))
    assert max(len(p.numbers) for p in paged.runs(range(2_000_000))) <= paged.RUN
    assert paged.runs([]) == []
