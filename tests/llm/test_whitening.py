"""Whitening against numbers of any size and against numpy, rank and odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm import whitening
from newslens.llm.queries import QUERIES

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        # Names that the operator uses inside.
        T.StructField("x", T.StringType()),
        T.StructField("deviation", T.StringType()),
    ]
)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", None) for i, v in rows], VECTORS)


def brute(rows, k):
    """The same by exact fractions: (n, sums, covariance) of the distinct vectors."""
    x = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in rows})
    n, d = len(x), len(x[0])
    sums = [sum(v[i] for v in x) for i in range(d)]
    cov = [[sum((Fraction(v[i]) - Fraction(sums[i], n)) * (Fraction(v[j]) - Fraction(sums[j], n)) for v in x) / n for j in range(d)] for i in range(d)]
    return n, sums, cov


def check(spark, rows, k=16):
    frame = vectors(spark, rows).repartition(3)
    model = whitening.fit(frame)
    good = [v for _, v in rows]
    n, sums, cov = brute(good, k)
    assert (model.n, list(model.sums)) == (n, sums)
    spread = whitening.covariances(frame.select(whitening.whole(F.col("embedding")).alias("x")).distinct(), n, sums)
    assert [[Fraction(c, n * n) for c in row] for row in spread] == cov
    exact = np.array([[float(c) for c in row] for row in cov])
    values = np.sort(np.linalg.eigvalsh(exact))[::-1][: len(model.values)]
    assert np.allclose(model.values, values, rtol=1e-9)
    assert np.allclose(model.explained, values / np.trace(exact), rtol=1e-9)
    assert model.error < 1e-6
    out = whitening.components(whitening.transform(frame, model), model).collect()
    assert len(out) == len(rows) * len(model.values)
    w = {}
    for r in out:
        x = [math.floor(64 * c) + 1_000_000 for c in dict(rows)[r["vec_id"]]]
        assert int(r["deviation"]) == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        away = np.array([float(a - Fraction(s, n)) for a, s in zip(x, sums)])
        k = r["component"] - 1
        assert abs(r["whitened"] - away @ model.directions[:, k] / math.sqrt(model.values[k])) < 1e-7
        w.setdefault(tuple(x), {})[k] = r["whitened"]
    table = np.array([[v[k] for k in sorted(v)] for v in w.values()])
    assert np.abs(np.cov(table.T, bias=True) - np.eye(table.shape[1])).max() < 1e-6
    return model


def test_small(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) + j for j in range(6)]) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(20)]
    assert len(check(spark, rows).values) == 6


def test_far_from_zero_and_wide(spark):
    """Values for which squares in floating point would leave nothing, and 64 bits do not hold them."""
    r = random.Random(2)
    rows = [(i, [3e9 + r.gauss(0, 1), -5e12 + r.gauss(0, 2), r.gauss(0, 1e10), r.gauss(0, 1e-3 if i % 9 else 1.0)]) for i in range(30)]
    check(spark, rows)


def test_rank(spark):
    """Directions without variance have no component."""
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    assert len(check(spark, rows).values) == 1
    alone = vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whitening.fit(alone) is None
    assert whitening.components(whitening.transform(alone, None), None).collect() == []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(20, None), (21, []), (22, [1.0, None]), (23, [nan, 1.0]), (24, [inf, 1.0]), (25, [1.0, 2.0, 3.0]), (26, [-inf, 0.0])]
    good = [(1, [1.0, 2.0]), (2, [3.0, -1.0]), (2, [3.0, -1.0]), (None, [0.5, 0.5])]
    frame = vectors(spark, bad + good)
    model = whitening.fit(frame)
    out = whitening.components(whitening.transform(frame, model), model)
    assert model.n == 3
    assert sorted((r["vec_id"] or -1, r["component"]) for r in out.collect()) == [(-1, 1), (-1, 2), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2)]
    none = vectors(spark, [])
    assert whitening.fit(none) is None
    assert whitening.components(whitening.transform(none, None), None).columns == out.columns


def test_query(spark, given):
    folder = "/root/testdata/sf0.001"
    out = QUERIES["op11_whitening"](spark, folder)
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double",
    }
    rows = out.collect()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    assert len(rows) == 16 * len(table)
    x = np.unique(np.floor(64 * np.array([r["embedding"] for r in table], np.float64)), axis=0)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    for r in rows:
        assert r["n"] == len(x) and r["identity_error"] < 1e-9
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-9
