"""The jobs end to end, from landed feeds to the summary."""

from newslens.__main__ import main
from newslens.sources.lexicon import sample_lexicon

RSS = "<rss><channel>{}</channel></rss>"
ITEM = "<item><title>{0}</title><link>http://s/{0}</link></item>"
API = '{"response": {"results": [{"webTitle": "g", "webUrl": "http://s/g"}]}}'


def test_feeds_to_summary(spark, tmp_path, capsys):
    p = lambda name: str(tmp_path / name)
    sample_lexicon(spark).write.parquet(p("lexicon"))
    pages = [(f"http://s/{n}", f"<title>{n}</title><body><article>best {n} words here</article>") for n in "abg"]
    pages.append(("http://s/c", "<body></body>"))
    spark.createDataFrame(pages, "url string, html string").write.parquet(p("pages"))
    (tmp_path / "bbc.xml").write_text(RSS.format(ITEM.format("a") + ITEM.format("videos/x")))
    (tmp_path / "reuters.xml").write_text(RSS.format(ITEM.format("b") + ITEM.format("c")))
    (tmp_path / "guardian.json").write_text(API)

    main(["publish", "--rss", f"BBC={p('bbc.xml')}", "--rss", f"Reuters={p('reuters.xml')}",
          "--api", f"Guardian={p('guardian.json')}", "--out", p("topics")], spark)
    for _ in range(2):
        main(["ingest", "--topics", p("topics"), "--pages", p("pages"), "--lexicon", p("lexicon"),
              "--out", p("tables"), "--checkpoint", p("c1"), "--once"], spark)
    raw = spark.read.parquet(p("tables/raw"))
    processed = spark.read.parquet(p("tables/processed"))
    assert raw.count() == 4 and processed.count() == 3
    assert spark.read.parquet(p("tables/rejected")).collect()[0]["url"] == "http://s/c"

    assert processed.where("processed_at IS NULL").count() == 0
    main(["stream", "--topics", p("tables/topics"), "--lexicon", p("lexicon"), "--metrics", p("metrics"),
          "--timing", p("timing"), "--checkpoint", p("c2"), "--once"], spark)
    main(["batch", "--articles", p("tables/processed"), "--lexicon", p("lexicon"),
          "--metrics", p("metrics"), "--timing", p("timing")], spark)

    shares, words, sources = main(
        ["summary", "--metrics", p("metrics")], spark)
    assert [tuple(r) for r in shares.collect()] == [("positive", 3, 100.0)]
    assert [(r["word"], r["count"]) for r in words.collect()] == [("best", 3), ("here", 3), ("words", 3)]
    assert {r["source"]: r["avg_length"] for r in sources.collect()} == {
        "BBC": 17.0, "Guardian": 17.0, "Reuters": 17.0}
    (compared,) = main(["compare", "--timing", p("timing")], spark)
    assert {r["processing_type"]: r["num_executions"] for r in compared.collect()} == {
        "batch": 1, "streaming": 1}
    tables = ["--processed_articles", p("tables/processed"), "--raw_articles", p("tables/raw")]
    (gaps,) = main(["check", *tables, "--analytics_results", p("metrics")], spark)
    assert gaps.count() == 0
    (gaps,) = main(["check", *tables, "--analytics_results", p("nowhere")], spark)
    assert [tuple(r) for r in gaps.collect()] == [("analytics_results", None, "absent", 0)]
