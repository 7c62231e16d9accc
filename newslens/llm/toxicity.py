"""Toxic passages by maximum-scoring segments over log-odds of tokens.

Every word gets the log-odds of standing in a toxic document against a clean one, with an
informative Dirichlet prior: each class is given pseudo-counts in proportion to how often
the word occurs at all, so rare words stay near zero. A word that the labelled rows do not
hold takes the log-odds of its longest known beginning. A constant drift is taken off each
word, which makes ordinary text score below zero, and one linear scan finds every maximal
segment with a positive sum. A segment's score S in a text of n words is compared with
chance as extreme values are: E = K n exp(-lambda S). The score of a document is a logistic
function, fitted on the labelled rows, of the evidence of its segments.

Defined cases: a null or empty text has no words and the score of no evidence; a null or
repeated doc_id yields one row per input row; without labelled rows of both classes all
scores are 0; an empty table gives no rows; columns other than id and text are not read, and
``without_toxic`` keeps them as they are. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import keep_rows, label_sample, labelled_texts, pieces, strings

WORD = re.compile(r"\w+")
#: Lengths of the beginnings that stand in for unknown words, the longest first.
STEMS = (5, 4)
#: Labelled rows used for fitting, at most about so many.
MAX_FIT_ROWS = 60_000
#: Tokens of the model, the most significant ones; bounds what is broadcast.
MAX_TOKENS = 50_000
#: Pseudo-count that each class gives a token, as a share of the documents that hold it.
PRIOR = 1 / 15
#: Least distance from zero, in standard errors, at which a token carries a score with
#: ``FEW_ROWS`` labelled rows; it rises with the logarithm of their number, because more
#: tokens are then looked at.
SIGNIFICANT, FEW_ROWS, RISE = 2.0, 300, 0.28
#: Score taken off each word.
DRIFT = 0.5
#: Expected chance segments per document below which a passage is reported.
MAX_E_VALUE = 0.05
THRESHOLD = 0.3

PASSAGES = "array<struct<start:int,end:int,score:double,e_value:double>>"
SCORES = f"doc_id long, score double, predicted int, evidence double, passages {PASSAGES}"
_FLUSH = 200_000


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    rate: float  # lambda
    log_k: float
    slope: float
    intercept: float

    def weight(self, word: str) -> float:
        known = self.words.get(word)
        if known is None:
            for n in STEMS:
                if len(word) > n and (known := self.stems.get(word[:n])) is not None:
                    break
        return known or 0.0


def lowered(text: str) -> str:
    """Lower case without a change of length, so that offsets hold in the text itself."""
    return text.replace("\u0130", "i").lower()


def tokens(text: str) -> set[str]:
    """Distinct words of a text, and their beginnings marked by a star."""
    words = set(WORD.findall(lowered(text)))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def flush() -> Iterator[pa.RecordBatch]:
        for label, counter in enumerate(counts):
            if counter:
                names, values = list(counter), list(counter.values())
                other = [0] * len(names)
                pair = (values, other) if label else (other, values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64())],
                    ["token", "toxic", "clean"],
                )
                counter.clear()

    for batch in pieces(batches):
        for text, label in zip(strings(batch, "text"), batch.column("label").to_pylist()):
            counts[1 if label else 0].update(tokens(text))
            if len(counts[0]) + len(counts[1]) > _FLUSH:
                yield from flush()
    yield from flush()


def significant_tokens(texts: DataFrame, toxic_docs: int, clean_docs: int) -> DataFrame:
    """(token, toxic, clean, log_odds) of tokens whose log-odds differ clearly from zero."""
    counted = (
        texts.select("text", "label")
        .mapInArrow(_count, "token string, toxic long, clean long")
        .groupBy("token")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    toxic, clean = (F.col(c) + PRIOR * (F.col("toxic") + F.col("clean")) for c in ("toxic", "clean"))
    both = PRIOR * (toxic_docs + clean_docs)
    odds = F.log(toxic / (toxic_docs + both - toxic + 0.5)) - F.log(clean / (clean_docs + both - clean + 0.5))
    scored = counted.select(
        "token", "toxic", "clean", odds.alias("log_odds"), F.sqrt(1 / toxic + 1 / clean).alias("error")
    ).withColumn("z", F.abs(F.col("log_odds") / F.col("error")))
    least = SIGNIFICANT + RISE * max(0.0, math.log((toxic_docs + clean_docs) / FEW_ROWS))
    return scored.where(F.col("z") >= least)


def _rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * score)) = 1; the mean score is negative."""
    low, high = 1e-6, 1.0
    value = lambda x: float(shares @ np.exp(np.minimum(x * scores, 500))) - 1
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """Every maximal-scoring segment (first, last + 1, sum), by one pass.

    ``scores`` are the words' scores. A stack holds the segments that may still grow.
    """
    # first, end, total before it, total after it, place of the nearest segment left of it
    # whose total before is lower. Following these links keeps the scan linear.
    stack: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, score in enumerate(scores):
        left = total
        total += score
        if score <= 0:
            continue
        first, k = i, len(stack) - 1
        while True:
            while k >= 0 and stack[k][2] >= left:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= total:
                break
            first, left = stack[k][0], stack[k][2]
            link = stack[k][4]
            del stack[k:]
            k = link
        stack.append((first, i + 1, left, total, k))
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def sparse_segments(places: list[int], weights: list[float]) -> list[tuple[int, int, float]]:
    """As ``segments`` over all words, given only the words whose score is not the drift.

    Words between two given ones each score -DRIFT, so a run of them is one negative step.
    """
    steps: list[float] = []
    at: list[int] = []
    previous = -1
    for place, weight in zip(places, weights):
        if gap := place - previous - 1:
            steps.append(-DRIFT * gap)
            at.append(-1)
        steps.append(weight - DRIFT)
        at.append(place)
        previous = place
    return [(at[a], at[b - 1] + 1, total) for a, b, total in segments(steps)]


def analyse(text: str, model: Model) -> tuple[float, list[tuple[int, int, float, float]]]:
    """The evidence against chance, and the passages as character offsets."""
    words = WORD.findall(lowered(text))
    known = {w: x for w in set(words) if (x := model.weight(w))}
    nothing = -model.log_k - math.log(max(1, len(words)))
    if not any(x > DRIFT for x in known.values()):
        return min(0.0, nothing), []
    places = [i for i, w in enumerate(words) if w in known]
    found = sparse_segments(places, [known[words[i]] for i in places])
    chance = [model.rate * s + nothing for _, _, s in found]  # -log of the E-value
    evidence = max(chance) + math.log(sum(math.exp(x - max(chance)) for x in chance))
    spans = None
    passages = []
    for (a, b, score), x in zip(found, chance):
        e_value = math.exp(-x) if x < 700 else 0.0
        if e_value <= MAX_E_VALUE:
            if spans is None:
                spans = [m.span() for m in WORD.finditer(lowered(text))]
            passages.append((spans[a][0], spans[b - 1][1], score, e_value))
    return evidence, passages


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps with a small ridge."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-2 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(documents: DataFrame, labels: DataFrame, keep=None) -> Model | None:
    """Fit on at most about ``MAX_FIT_ROWS`` labelled rows that satisfy ``keep``."""
    sample = label_sample(labels, "toxic", F.lit(True) if keep is None else keep, MAX_FIT_ROWS)
    texts = labelled_texts(documents, sample)
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic_docs, clean_docs = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic_docs or not clean_docs:
        return None
    rows = (
        significant_tokens(texts, toxic_docs, clean_docs)
        .orderBy(F.desc("z"), "token")
        .limit(MAX_TOKENS)
        .collect()
    )
    words = {r["token"]: r["log_odds"] for r in rows if not r["token"].endswith("*")}
    stems = {r["token"][:-1]: r["log_odds"] for r in rows if r["token"].endswith("*")}
    # Scores as clean documents hold them: presence per document, the rest is the drift.
    shares = np.array([(r["clean"] + 0.5) / clean_docs for r in rows if not r["token"].endswith("*")] + [0.0])
    scores = np.array([r["log_odds"] - DRIFT for r in rows if not r["token"].endswith("*")] + [-DRIFT])
    per_doc = 200.0  # words per document that presence is spread over
    shares /= per_doc
    shares[-1] = max(0.0, 1 - shares[:-1].sum())
    rate = _rate(scores, shares / shares.sum()) if len(rows) else 1.0
    raw = Model(words, stems, rate, math.log(0.1), 1.0, 0.0)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = [analyse(text, raw)[0] for text in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.float64()), batch.column("label").cast(pa.int32())], ["x", "y"]
            )

    seen = texts.select("text", "label").mapInArrow(evidence, "x double, y int").toPandas()
    slope, intercept = _logistic(np.clip(seen["x"].to_numpy(), -20, 20), seen["y"].to_numpy(dtype=float))
    return Model(words, stems, rate, raw.log_k, slope, intercept)


def probability(evidence: float, model: Model) -> float:
    x = model.slope * min(20.0, max(-20.0, evidence)) + model.intercept
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def without_toxic(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents that score below ``THRESHOLD``, with all their columns."""
    if model is None:
        return documents
    return keep_rows(documents, lambda texts: [probability(analyse(t, model)[0], model) < THRESHOLD for t in texts])


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: score, prediction, evidence and the toxic passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores, evidences, passages = [], [], []
            for text in strings(batch, "text"):
                evidence, found = (0.0, []) if model is None else analyse(text, model)
                scores.append(0.0 if model is None else probability(evidence, model))
                evidences.append(evidence)
                passages.append([dict(zip(("start", "end", "score", "e_value"), p)) for p in found])
            kind = pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                    pa.array(evidences, pa.float64()),
                    pa.array(passages, kind),
                ],
                ["doc_id", "score", "predicted", "evidence", "passages"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, SCORES)
