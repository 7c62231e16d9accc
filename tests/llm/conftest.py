import os

import pytest
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"

WORDS = "the of and river stone walks slowly under bright heavy cloud while seven old boats drift past quiet harbour walls today".split()


def sentence(seed: int, n: int) -> str:
    """Invented prose that differs from seed to seed."""
    state, out = seed * 7919 + 13, []
    for i in range(n):
        state = (state * 1103515245 + 12345) & 0x7FFFFFFF
        out.append(WORDS[state % len(WORDS)] + ("x" * (state // 97 % 3)) + str(state // 31 % 50))
        if i % 12 == 11:
            out[-1] += "."
    return " ".join(out)


DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside for their own columns.
        T.StructField("id", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("node", T.StringType()),
    ]
)


def frame(spark, rows):
    """Documents from (doc_id, text), with columns whose names clash."""
    full = [(i, t, "en", None, None if t is None else len(t), "x", None, "y") for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS)


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, a null id, repeated rows, a very long text, unusual characters."""
    long = sentence(1, 30_000)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "İstanbul ΣΑΣ 日本 😀 ́"), (None, "nobody's text"),
        (None, None), (6, long), (7, long), (8, sentence(2, 80)), (9, sentence(2, 80)), (10, "a " * 300), (-3, sentence(3, 60)),
    ]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def given(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
