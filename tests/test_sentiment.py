import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newslens.functions.sentiment import LexiconTooLarge, load_lexicon, polarity
from newslens.operators import sentiment as Sent

WORDS = [
    ("good", 700, "polar"),
    ("fine", 100, "polar"),
    ("bad", -700, "polar"),
    ("odd", -100, "polar"),
    ("very", 1300, "intensifier"),
    ("hardly", 500, "intensifier"),
    ("not", 0, "negator"),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(WORDS, "word string, score int, kind string")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "raw_id int, content string")


CASES = {
    None: "neutral",
    "": "neutral",
    "  ": "neutral",
    "nothing here": "neutral",
    "Good!": "positive",
    "bad": "negative",
    "good bad": "neutral",
    "good good bad": "positive",
    "not good": "negative",
    "not bad": "positive",
    "not very bad": "positive",
    "very not bad": "positive",
    "not hardly good bad": "negative",
    "not, good": "negative",
    "not so good": "positive",
    "fine": "positive",
}


def test_labels(spark, table):
    texts = list(CASES)
    got = Sent.with_sentiment(frame(spark, texts), load_lexicon(table)).orderBy("raw_id").collect()
    assert {t: r["sentiment"] for t, r in zip(texts, got)} == CASES


def test_threshold_is_exclusive(spark, table):
    texts = ["fine", "odd", "good", "bad", "good odd fine", "fine fine odd"]
    got = Sent.with_sentiment(frame(spark, texts), load_lexicon(table), threshold=100)
    assert [r["sentiment"] for r in got.orderBy("raw_id").collect()] == [
        "neutral", "neutral", "positive", "negative", "positive", "neutral",
    ]


def test_weights(spark, table):
    lexicon = load_lexicon(table)
    rows = frame(spark, ["very good, not very bad", "good bad"])
    got = rows.orderBy("raw_id").select(polarity(F.col("content"), lexicon).alias("p")).collect()
    million = 1_000_000
    assert tuple(got[0]["p"]) == (700 * 1300 * 1000 + -700 * 1300 * -500, 2)
    assert tuple(got[1]["p"]) == (0, 2)
    plain = rows.orderBy("raw_id").select(polarity(F.col("content"), lexicon, False).alias("p")).collect()
    assert tuple(plain[0]["p"]) == (0 * million, 2)


def test_join_gives_the_same_labels(spark, table):
    rng = random.Random(7)
    words = [w for w, _, _ in WORDS] + ["so", "the", ""]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(300)] + [None, ""]
    rows = frame(spark, texts)
    for modifiers in (True, False):
        for threshold in (0, 100):
            inline = Sent.with_sentiment(rows, load_lexicon(table), modifiers, threshold)
            joined = Sent.score_articles(rows, table, "raw_id", modifiers, threshold, max_words=4)
            assert dict(inline.select("raw_id", "sentiment").collect()) == dict(
                joined.select("raw_id", "sentiment").collect()
            )


def test_large_lexicon_is_refused_and_joined(spark, table):
    with pytest.raises(LexiconTooLarge):
        load_lexicon(table, max_words=6)
    plan = Sent.score_articles(frame(spark, ["good"]), table, max_words=4)
    assert "Join" in plan._jdf.queryExecution().executedPlan().toString()


def test_many_words(spark):
    rows = [(f"w{i}", i - 2500, "polar") for i in range(5000)]
    lexicon = load_lexicon(spark.createDataFrame(rows, "word string, score int, kind string"))
    texts = [f"w{i}" for i in range(5000)]
    got = Sent.with_sentiment(frame(spark, texts), lexicon, modifiers=False).orderBy("raw_id").collect()
    want = ["negative" if i < 2500 else "neutral" if i == 2500 else "positive" for i in range(5000)]
    assert [r["sentiment"] for r in got] == want


def test_lexicon_kind_is_checked(spark):
    for kind in ("other", None):
        odd = spark.createDataFrame([("a", 1, kind)], "word string, score int, kind string")
        with pytest.raises(Exception, match="unknown lexicon kind"):
            load_lexicon(odd)
        with pytest.raises(Exception, match="unknown lexicon kind"):
            Sent.join_sentiment(frame(spark, ["a"]), odd).collect()


def test_one_lexicon_means_the_same_on_every_path(spark):
    rows = [("good", 500, "polar"), ("good", -400, "polar"), ("fine", 300, "polar"), ("", 900, "polar"), ("dull", None, "polar"),
            (None, 5, "polar"), ("not", None, "negator"), ("very", None, "intensifier"), ("very", 1500, "intensifier"), ("bad", -700, "polar")]
    table = spark.createDataFrame(rows, "word string, score int, kind string")
    texts = ["good", "fine dull", "not fine", "very bad  good", "dull", "", "bad very good good good"]
    articles = frame(spark, texts)
    for threshold in (0, 100):
        paths = [
            Sent.with_sentiment(articles, load_lexicon(table), threshold=threshold),
            Sent.join_sentiment(articles, table, "raw_id", threshold=threshold),
            Sent.join_sentiment(articles, table, "raw_id", threshold=threshold, broadcast_words=0),
        ]
        labels = [sorted((r["raw_id"], r["sentiment"]) for r in p.collect()) for p in paths]
        assert labels[0] == labels[1] == labels[2] and labels[0][0][1] in ("positive", "neutral")


def test_words_meet_a_small_lexicon_without_a_shuffle(spark, table):
    joined = Sent.join_sentiment(frame(spark, ["good bad"]).select("raw_id", "content"), table)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_scoring_keeps_no_shuffle(spark, table):
    scored = Sent.with_sentiment(frame(spark, ["good"]), load_lexicon(table))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "from_json" not in plan


def test_custom_scorer(spark):
    def length_scorer(texts: pd.Series) -> pd.Series:
        return texts.str.len().astype("float64") - 3

    rows = frame(spark, ["ab", "abc", "abcd", "", None])
    got = Sent.with_custom_sentiment(rows, length_scorer).orderBy("raw_id").collect()
    assert [r["sentiment"] for r in got] == ["negative", "neutral", "positive", "neutral", "neutral"]
