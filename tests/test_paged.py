"""Numbered pages as a source: each read once, in order, across restarts and gaps."""

import json

import pytest

from newslens.sources.paged import PagedFeed, pages_landed

ONCE = {"availableNow": True}


@pytest.fixture
def folder(spark, tmp_path):
    spark.dataSource.register(PagedFeed)
    return tmp_path


def land(folder, page, *titles, lines=False):
    place = folder / "pages" / f"page={page}"
    place.mkdir(parents=True)
    found = [{"response": {"results": [{"webTitle": t, "webUrl": f"http://{t}"}]}} for t in titles]
    if lines:
        (place / "part-0.json").write_text("\n".join(map(json.dumps, found)))
    else:
        for i, one in enumerate(found):
            (place / f"part-{i}.json").write_text(json.dumps(one, indent=1))
    (place / "_SUCCESS").write_text("")


def taken(spark, folder):
    stream = spark.readStream.format("paged_feed").option("source", "G").load(str(folder / "pages"))
    query = stream.writeStream.format("parquet").option("path", str(folder / "out")).option(
        "checkpointLocation", str(folder / "c")
    ).trigger(**ONCE).start()
    query.awaitTermination()
    return sorted((r["page"], r["title"], r["source"]) for r in spark.read.schema("source string, title string, url string, page bigint").parquet(str(folder / "out")).collect())


def test_pages_once_across_restarts_and_gaps(spark, folder):
    land(folder, 1, "a", "b")
    land(folder, 2, "c", "d", lines=True)
    land(folder, 4, "z")
    want = [(1, "a", "G"), (1, "b", "G"), (2, "c", "G"), (2, "d", "G")]
    assert taken(spark, folder) == want
    assert taken(spark, folder) == want
    land(folder, 3)
    assert taken(spark, folder) == [*want, (4, "z", "G")]
    assert pages_landed(str(folder / "pages")) == [1, 2, 3, 4]


def test_batch_reads_what_there_is(spark, folder):
    land(folder, 1, "a")
    place = folder / "pages" / "page=3"
    place.mkdir(parents=True)
    (place / "x.json").write_text('{"response": null}\n{"other": 1}\n')
    table = spark.read.format("paged_feed").load(f"file:{folder}/pages")
    assert [tuple(r) for r in table.collect()] == [("", "a", "http://a", 1)]
    assert table.rdd.getNumPartitions() == 2


def test_nothing_landed_yet(spark, folder):
    assert spark.read.format("paged_feed").load(str(folder / "none")).count() == 0
