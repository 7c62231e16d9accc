"""Document quality by a generalised additive model with pairwise interactions.

A document becomes a few numbers about its characters, words and lines. Each is cut into
bins at quantiles. Boosting goes round the features in turn and adds a small tree of at
most three leaves to the lookup table of that one feature; then the pairs of features that
explain most of what is left get tables of their own, grown in the same way by trees of
depth two. A score is the sum of the table entries at the document's bins, as a logistic
value. Only table lookups and additions are needed to score.

The model is fitted on a bounded sample of the labelled rows; its size depends on the
numbers of features and bins alone.

Defined cases: a null text is scored as an empty one; each input row yields one row, also
for null or repeated ids; without labelled rows of both classes every score is 0.5, so
that no document is rejected; an empty table gives no rows; columns other than id and text
are not read, and ``without_poor`` keeps them as they are. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import code_points, keep_rows, label_sample, labelled_texts, pieces, slices, strings, sums_between

#: Labelled rows used for fitting, at most about so many.
MAX_FIT_ROWS = 20_000
BINS = 32
ROUNDS = 200
RATE = 0.15
PAIRS = 6
PAIR_BINS = 8
PAIR_ROUNDS = 60
#: Weight that a leaf must have before its value counts in full.
RIDGE = 2.0
THRESHOLD = 0.3
SCORES = "doc_id long, score double, predicted int"

# Kinds of characters.
OTHER, LOWER, UPPER, DIGIT, SPACE, LINE, STOP, MARK, SYMBOL = range(9)


def _kind(char: str) -> int:
    if char == "\n":
        return LINE
    if char.isspace():
        return SPACE
    if char.isupper():
        return UPPER
    if char.isalpha():
        return LOWER
    if char.isdigit():
        return DIGIT
    if char in ".,;:'\"()-?":
        return STOP
    if char in "!":
        return MARK
    return SYMBOL if char.isprintable() else OTHER


KIND = np.array([_kind(chr(i)) for i in range(0x10000)], np.uint8)

FEATURES = (
    "log_chars",
    "log_words",
    "upper_share",
    "digit_share",
    "stop_share",
    "mark_share",
    "symbol_share",
    "other_share",
    "word_length",
    "distinct_words",
    "repeated_next",
    "words_per_line",
    "distinct_lines",
    "short_words",
    "longest_word",
)


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` a text."""
    codes, ends = code_points(texts)
    kinds = KIND[np.minimum(codes, 0xFFFF)]
    count = {k: sums_between(kinds == k, ends) for k in range(9)}
    chars = np.diff(ends).astype(float)
    solid = np.maximum(1.0, chars - count[SPACE] - count[LINE])
    out = np.zeros((len(texts), len(FEATURES)))
    out[:, 0] = np.log1p(chars)
    for column, kind in ((2, UPPER), (3, DIGIT), (4, STOP), (5, MARK), (6, SYMBOL), (7, OTHER)):
        out[:, column] = count[kind] / solid
    for i, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if not n:
            continue
        lines = text.split("\n")
        lengths = list(map(len, words))
        out[i, 1] = np.log1p(n)
        out[i, 8] = solid[i] / n
        out[i, 9] = len(set(words)) / n
        out[i, 10] = sum(map(eq, words, words[1:])) / n
        out[i, 11] = np.log1p(n / len(lines))
        out[i, 12] = len(set(lines)) / len(lines)
        out[i, 13] = sum(map((3).__ge__, lengths)) / n
        out[i, 14] = np.log1p(max(lengths))
    return out


@dataclass(frozen=True)
class Model:
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    intercept: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], rows[:, k], side="right")]
        for a, b, table in self.pairs:
            i = np.searchsorted(self.pair_edges[a], rows[:, a], side="right")
            j = np.searchsorted(self.pair_edges[b], rows[:, b], side="right")
            total += table[i, j]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _value(g: float, h: float) -> float:
    return g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins in two."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = (
        left_g**2 / (left_h + RIDGE)
        + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE)
        - all_g**2 / (all_h + RIDGE)
    )
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of the bins by a tree with at most three leaves."""
    cuts = [0, len(g)]
    for _ in range(2):
        found = []
        for a, b in zip(cuts, cuts[1:]):
            gain, k = _best_cut(g[a:b], h[a:b])
            found.append((gain, a + k))
        gain, place = max(found)
        if gain <= 1e-9:
            break
        cuts = sorted({*cuts, place})
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _value(g[a:b].sum(), h[a:b].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a grid by a tree of depth two: one cut along an axis, then one in each half."""
    best, out = 0.0, np.zeros_like(g)
    for axis in (0, 1):
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        for k in range(1, gg.shape[0]):
            values, gain = np.zeros_like(gg), 0.0
            for part in (slice(0, k), slice(k, None)):
                column_g, column_h = gg[part].sum(axis=0), hh[part].sum(axis=0)
                cut_gain, cut = _best_cut(column_g, column_h)
                total_g, total_h = column_g.sum(), column_h.sum()
                gain += total_g**2 / (total_h + RIDGE) + cut_gain
                cut = cut if cut_gain > 1e-9 else len(column_g)
                for side in (slice(0, cut), slice(cut, None)):
                    values[part, side] = _value(column_g[side].sum(), column_h[side].sum())
            if gain > best + 1e-12:
                best, out = gain, values if axis == 0 else values.T
    return out, best


def fit_rows(rows: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting over single features, then over the chosen pairs."""
    width = rows.shape[1]
    edges = [_edges(rows[:, k], BINS) for k in range(width)]
    places = [np.searchsorted(edges[k], rows[:, k], side="right") for k in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    intercept = float(np.log(share / (1 - share)))
    total = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for k in range(width):
            g, h = slopes()
            size = len(tables[k])
            step = RATE * _tree(np.bincount(places[k], g, size), np.bincount(places[k], h, size))
            tables[k] += step
            total += step[places[k]]
    pair_edges = [_edges(rows[:, k], PAIR_BINS) for k in range(width)]
    coarse = [np.searchsorted(pair_edges[k], rows[:, k], side="right") for k in range(width)]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        flat = np.bincount(coarse[a] * shape[1] + coarse[b], values, shape[0] * shape[1])
        return flat.reshape(shape)

    g, h = slopes()
    gains = [(_pair_tree(grid(a, b, g), grid(a, b, h))[1], a, b) for a, b in combinations(range(width), 2)]
    pairs = [(a, b, np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1))) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in pairs:
            g, h = slopes()
            step = RATE * _pair_tree(grid(a, b, g), grid(a, b, h))[0]
            table += step
            total += step[coarse[a], coarse[b]]
    return Model(edges, tables, pair_edges, pairs, intercept)


def _rows_of(texts: list[str]) -> np.ndarray:
    parts = [features(texts[a:b]) for a, b in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def fit(documents: DataFrame, labels: DataFrame, keep: Column | None = None) -> Model | None:
    """Fit on at most about ``MAX_FIT_ROWS`` labelled rows that satisfy ``keep``."""
    sample = label_sample(labels, "quality", F.lit(True) if keep is None else keep, MAX_FIT_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = _rows_of(strings(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(list(rows), pa.list_(pa.float64())),
                    batch.column("label").cast(pa.int32()),
                ],
                ["doc_id", "x", "y"],
            )

    found = (
        labelled_texts(documents, sample)
        .mapInArrow(run, "doc_id long, x array<double>, y int")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    y = found["y"].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    return fit_rows(np.stack(found["x"].to_numpy()), y)


def without_poor(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents that score ``THRESHOLD`` or more, with all their columns."""
    if model is None:
        return documents
    return keep_rows(documents, lambda texts: (model.scores(_rows_of(texts)) >= THRESHOLD).tolist())


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted): how likely a document is to be good."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = strings(batch, "text")
            values = np.full(len(texts), 0.5) if model is None else model.scores(_rows_of(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(values, pa.float64()),
                    pa.array((values >= THRESHOLD).astype(np.int32)),
                ],
                ["doc_id", "score", "predicted"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, SCORES)
