"""Toxicity, language and quality by held-out accuracy; nearest neighbours by recall; the pipeline."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newslens.llm import ann, language, quality, toxicity
from newslens.llm.common import fold, label_sample, one_label
from newslens.llm.queries import QUERIES

from .conftest import FOLDER, frame, sentence

BIGGER = "/root/testdata/sf0.01"


def accuracy(spark, name, label):
    out = QUERIES[name](spark, BIGGER)
    assert out.count() == spark.read.parquet(f"{BIGGER}/documents.parquet").count()
    labels = spark.read.parquet(f"{BIGGER}/labels.parquet")
    rows = out.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    return np.mean([r["predicted"] == r[label] for r in rows])


def test_toxicity_held_out(spark):
    assert accuracy(spark, "op6_toxicity", "toxic") > 0.92


def test_quality_held_out(spark):
    assert accuracy(spark, "op10_quality", "quality") > 0.95


def test_language_held_out(spark):
    out = QUERIES["op7_language"](spark, BIGGER)
    langs = spark.read.parquet(f"{BIGGER}/documents.parquet").select("doc_id", "lang")
    rows = out.where("held_out").join(langs, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


def test_held_out_rows_teach_nothing(spark):
    """Labels of held-out rows may be anything without a change of any score."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = fold(F.col("doc_id"), 5) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [sorted(map(tuple, quality.score(documents, quality.fit(documents, x, ~held)).collect())) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_label_rules(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    assert sorted(map(tuple, one_label(labels, "toxic").collect())) == [(1, 1), (3, 0)]
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    n = label_sample(many, "toxic", F.lit(True), 500).count()
    assert 350 < n < 650


def brute_segments(scores):
    """Maximal segments by their definition: the best one, then what is left of it and right of it."""
    best, where = 0.0, None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > best + 1e-12:
                best, where = total, (a, b + 1)
    if where is None:
        return []
    a, b = where
    left, right = brute_segments(scores[:a]), brute_segments(scores[b:])
    return left + [(a, b, best)] + [(x + b, y + b, s) for x, y, s in right]


def test_all_maximal_segments():
    r = random.Random(1)
    for _ in range(300):
        scores = [r.choice([-3, -2, -1, 1, 2, 3]) + r.random() / 8 for _ in range(r.randrange(0, 25))]
        got = toxicity.segments(scores)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_many_segments_take_linear_time():
    assert len(toxicity.segments([1.0, -1.0] * 200_000)) == 200_000


def small_model():
    return toxicity.Model({"scum": 6.0, "moron": 6.0}, {"lowei": 5.0}, 1.0, math.log(0.1), 1.0, -2.0)


def test_passages_have_offsets_in_the_text():
    text = "Fine words. İ You SCUM, you moron and loweischaft! " + sentence(1, 50)
    _, passages = toxicity.analyse(text, small_model())
    (a, b, score, e_value) = passages[0]
    assert text[a:b].startswith("SCUM") and text[a:b].endswith("loweischaft") and e_value < 0.05 and score > 10
    assert toxicity.analyse("", small_model()) == (0.0, []) or toxicity.analyse("", small_model())[1] == []


@pytest.mark.parametrize("model", [None, small_model()])
def test_toxicity_odd_documents(spark, odd, empty, model):
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.without_toxic(odd, model).columns == odd.columns
    assert toxicity.without_toxic(odd, model).count() == odd.count()
    assert toxicity.score(empty, model).count() == 0


def test_without_labels_nothing_is_rejected(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.fit(odd, none) is None and quality.fit(odd, none) is None and quality.fit(empty, none) is None
    assert quality.without_poor(odd, None).count() == odd.count()
    assert {r["score"] for r in quality.score(odd, None).collect()} == {0.5}


def test_language_odd_documents(spark, odd, empty):
    model = language.fit(odd.withColumn("lang", F.when(F.col("doc_id") > 5, F.lit("en")).when(F.col("doc_id") == 5, F.lit("xx"))))
    rows = {r["doc_id"]: r for r in language.predict(odd, model).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == rows[3]["lang_pred"] == "und" and rows[1]["score"] == 0
    assert rows[8]["lang_pred"] == "en" and rows[8]["score"] > 0.5
    nothing = language.fit(empty)
    assert {r["lang_pred"] for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_language_scores_by_definition():
    texts = ["abc de", "Xyz!", "", "12"]
    bucket, owner, letters = language.grams(texts)
    assert letters.tolist() == [5, 3, 0, 0]
    # " abc de ": blanks and letters 8, pairs 7, triples 6.
    assert (owner == 0).sum() == 8 + 7 + 6
    assert (bucket < language.BUCKETS).all()


def test_quality_learns_a_pair():
    r = np.random.default_rng(0)
    rows = r.random((1500, 3))
    y = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.fit_rows(rows, y)
    assert np.mean((model.scores(rows) > 0.5) == y) > 0.95
    assert {p[:2] for p in model.pairs} >= {(0, 1)}


# Nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, list int")


def exact(rows, k, every):
    out = {}
    for i, v, *_ in rows:
        if i is not None and i % every == 0:
            near = sorted((-float(np.dot(v, w)), j) for j, w, *_ in rows if j != i)[:k]
            out[i] = near
    return out


def test_ann_recall(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=16).tolist(), None, 1) for i in range(1200)]
    found = {}
    for x in ann.search(vectors(spark, rows), "embedding").collect():
        found.setdefault(x["query_id"], {})[x["rank"]] = (x["vec_id"], x["score"])
    table = {i: v for i, v, *_ in rows}
    want = exact(rows, 20, 20)
    assert found.keys() == want.keys()
    hits = 0
    for q, near in want.items():
        assert sorted(found[q]) == list(range(1, 21))
        ranked = [found[q][k] for k in range(1, 21)]
        assert ranked == sorted(ranked, key=lambda p: (-p[1], p[0]))
        assert all(s == pytest.approx(float(np.dot(table[q], table[v])), abs=1e-12) for v, s in ranked)
        hits += len({v for v, _ in ranked} & {j for _, j in near})
    assert hits / (20 * len(want)) >= 0.9


def test_ann_queries_of_the_given_table(spark):
    out = QUERIES["op3_ann"](spark, BIGGER).toPandas()
    given = spark.read.parquet(f"{BIGGER}/embeddings.parquet").toPandas()
    table = np.stack(given["embedding"]).astype(float)
    ids = given["vec_id"].to_numpy()
    hits = total = 0
    for q, own in out.groupby("query_id"):
        scores = table @ table[ids == q][0]
        scores[ids == q] = -np.inf
        near = ids[np.lexsort((ids, -scores))[:20]]
        hits, total = hits + len(set(near) & set(own["vec_id"])), total + 20
    assert total == 20 * (ids % 20 == 0).sum() and hits / total >= 0.9


def test_ann_ties_copies_and_unusable_vectors(spark):
    same = [1.0, 0.0]
    rows = [(i, same, None, None) for i in range(0, 90)] + [(i, same, None, None) for i in range(0, 3)]
    rows += [(100, [0.0, 1.0], None, None), (120, None, None, None), (140, [0.0, 0.0], None, None), (160, [float("nan"), 1.0], None, None)]
    rows += [(180, [1.0, None], None, None), (200, [1.0, 2.0, 3.0], None, None), (None, same, None, None)]
    found = {}
    for x in ann.search(vectors(spark, rows), "embedding").collect():
        found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    assert set(found) == {0, 20, 40, 60, 80, 100}
    assert sorted(found[0]) == [(k, k, 1.0) for k in range(1, 21)]
    assert [v for _, v, _ in sorted(found[20])] == [*range(0, 20)]
    assert [v for _, v, _ in sorted(found[100])] == [*range(0, 20)]


def test_ann_few_and_no_vectors(spark):
    few = vectors(spark, [(0, [1.0, 2.0], None, None), (1, [2.0, 1.0], None, None), (2, [-1.0, 0.0], None, None)])
    assert [(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in ann.search(few, "embedding").collect()] == [(0, 1, 1, 4.0), (0, 2, 2, -1.0)]
    assert ann.search(vectors(spark, []), "embedding").count() == 0
    one = vectors(spark, [(0, [1.0], None, None)])
    assert ann.search(one, "embedding").count() == 0


# The pipeline


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "repeated_passages", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= kept
        kept = set(ids)
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == kept


def test_pipeline_stages_on_odd_documents(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            docs.collect()


def test_one_labelled_text_per_id(spark):
    from newslens.llm.common import labelled_texts

    rows = [(1, f"text {k}") for k in range(40)] + [(2, "b"), (2, "b"), (3, None), (4, "not labelled"), (None, "x")]
    sample = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (9, 0)], "doc_id long, label int")
    found = labelled_texts(frame(spark, rows).repartition(5), sample).collect()
    assert sorted((r["doc_id"], r["text"], r["label"]) for r in found) == [(1, "text 0", 1), (2, "b", 0), (3, "", 1)]
