from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newslens.functions.text import preview, strip, word_count
from newslens.operators import words as W

TEXTS = [None, "", "  ", "a", " a  b\n", "Café au lait", "x y　z", "\x1ca\x1f", "1,2;3"]


def test_word_count_is_python_split(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = dict(rows.select("i", word_count(F.col("t"))).collect())
    assert got == {i: None if t is None else len(t.split()) for i, t in enumerate(TEXTS)}


@settings(max_examples=3, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("ab \t\n\r\x0b\x0c\x1c\x1f\x85\xa0   ​   　")), min_size=50, max_size=50))
def test_blanks_are_python_blanks(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = rows.orderBy("i").select(word_count(F.col("t")), strip(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(len(t.split()), t.strip()) for t in texts]


def test_preview(spark):
    rows = spark.createDataFrame([("x" * 201,), ("é",), (None,)], "t string")
    assert [r[0] for r in rows.select(preview(F.col("t"))).collect()] == ["x" * 200, "é", None]


def articles(spark, *contents):
    return spark.createDataFrame([(i, c) for i, c in enumerate(contents)], "raw_id int, content string")


def counts(df):
    return {r["word"]: r["count"] for r in df.collect()}


def test_long_words(spark):
    rows = articles(spark, "Word WORD wor word1 cafés abcd-efgh", None, "")
    assert counts(W.count_words(W.long_words(rows))) == {"word": 2, "abcd": 1, "efgh": 1}


def test_all_words(spark):
    rows = articles(spark, "Word word, 12 a", None, "", "...")
    assert counts(W.count_words(W.all_words(rows))) == {"Word": 1, "word": 1, "12": 1, "a": 1}


def test_content_words(spark):
    rows = articles(spark, "The cat AND the Dog", "the", None)
    assert counts(W.count_words(W.content_words(rows))) == {"cat": 1, "dog": 1}


def test_ties_go_by_word(spark):
    rows = articles(spark, "d c b a a")
    top = W.top_words(W.count_words(W.all_words(rows)), 3).collect()
    assert [(r["word"], r["count"]) for r in top] == [("a", 2), ("b", 1), ("c", 1)]


def test_top_words_per_group(spark):
    rows = articles(spark, "b a a", "c d c")
    per = W.count_words(W.all_words(rows, ["raw_id"]), ["raw_id"])
    top = W.top_words_per(per, ["raw_id"], 1).orderBy("raw_id").collect()
    assert [(r["raw_id"], r["word"], r["count"], r["rank"]) for r in top] == [
        (0, "a", 2, 1),
        (1, "c", 2, 1),
    ]


def test_ranking_cuts_groups_before_the_shuffle(spark):
    per = W.count_words(W.all_words(articles(spark, "a b"), ["raw_id"]), ["raw_id"])
    plan = W.top_words_per(per, ["raw_id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
