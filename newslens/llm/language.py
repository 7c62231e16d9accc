"""Language by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; each run of letters, with one blank before and after, gives its
n-grams of 1 to 3 characters, hashed into a fixed number of buckets. Training counts
buckets per language inside the tasks and adds the counts up with one grouping. The model
is a matrix of log-probabilities, buckets by languages, whose size does not depend on the
corpus; scoring adds up its rows for all n-grams of many texts at once.

Defined cases: a null text, or one without a letter, gets ``und`` and score 0, as does
every text when nothing could be learned; rows with a null language are not learned from;
each input row yields one row, also for null or repeated ids. Ties go to the language
that sorts first; an empty table gives no rows; columns other than id, text and lang are
not read. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import code_points, slices, strings, sums_between

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Pseudo-count of each bucket.
SMOOTHING = 0.5
UNKNOWN = "und"
PREDICTIONS = "doc_id long, lang_pred string, score double"


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    log_prior: np.ndarray  # languages
    log_prob: np.ndarray  # buckets x languages


def _letters() -> np.ndarray:
    """For each character of the first plane: is it a letter? Others are taken as letters."""
    return np.frombuffer(bytes(chr(i).isalpha() for i in range(0x10000)), np.bool_)


LETTER = _letters()


def is_letter(codes: np.ndarray) -> np.ndarray:
    flags = LETTER[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        flags[beyond] = [chr(c).isalpha() for c in codes[beyond]]
    return flags


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per n-gram its bucket and its text's number; and per text its number of letters.

    Everything that is no letter becomes one blank, so n-grams reach over at most one gap
    and never from one text into the next.
    """
    codes, ends = code_points([f" {t.lower()} " for t in texts])
    letter = is_letter(codes)
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    counts = sums_between(letter, ends)
    # Keep letters, and the first of each run of other characters as a blank.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[ends[:-1]] = True
    codes = np.where(letter, codes, 32)[keep].astype(np.uint32)
    owner = owner[keep].astype(np.int32)
    found, owners = [], []
    value = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        value = value[:size] * np.uint32(0x9E3779B1) + codes[n - 1 :] + np.uint32(n)
        if n in ORDERS:
            same = owner[:size] == owner[n - 1 :]
            mixed = value ^ (value >> np.uint32(15))
            mixed = mixed * np.uint32(0x85EBCA6B)
            bucket = (mixed >> np.uint32(16)) & np.uint32(BUCKETS - 1)
            found.append(bucket[same])
            owners.append(owner[:size][same])
    return np.concatenate(found or [value]), np.concatenate(owners or [owner]), counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        texts, langs = strings(batch, "text"), batch.column("lang").to_pylist()
        for a, b in slices(texts):
            bucket, owner, _ = grams(texts[a:b])
            names, index = np.unique(langs[a:b], return_inverse=True)
            flat = np.bincount(bucket + index[owner] * BUCKETS, minlength=BUCKETS * len(names))
            for k, name in enumerate(names.tolist()):
                part = flat[k * BUCKETS : (k + 1) * BUCKETS]
                counts[name] = counts[name] + part if name in counts else part
                docs[name] = docs.get(name, 0) + int((index == k).sum())
    for name, values in counts.items():
        places = np.flatnonzero(values)
        # Bucket -1 carries the number of documents.
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * (len(places) + 1)),
                pa.array(np.append(places, -1), pa.int32()),
                pa.array(np.append(values[places], docs[name]), pa.int64()),
            ],
            ["lang", "bucket", "n"],
        )


def fit(documents: DataFrame, keep: Column | None = None) -> Model:
    """Learn from all documents with a language that satisfy ``keep``."""
    rows = documents.where(F.lit(True) if keep is None else keep).where("lang IS NOT NULL")
    counted = (
        rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        # One row a language: the driver gets buckets x languages numbers, whatever the corpus.
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
        .toArrow()
        .to_pylist()
    )
    counted.sort(key=lambda r: r["lang"])
    langs = tuple(r["lang"] for r in counted)
    totals = np.full((BUCKETS, len(langs)), SMOOTHING)
    docs = np.ones(len(langs))
    for k, row in enumerate(counted):
        for pair in row["counts"]:
            if pair["bucket"] < 0:
                docs[k] = pair["n"]
            else:
                totals[pair["bucket"], k] += pair["n"]
    log_prob = np.log(totals) - np.log(totals.sum(axis=0)) if langs else totals
    return Model(langs, np.log(docs / docs.sum()) if langs else docs, log_prob.astype(np.float32))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language and its posterior probability."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = strings(batch, "text")
            names, scores = [], []
            for a, b in slices(texts):
                bucket, owner, letters = grams(texts[a:b])
                if not known.langs:
                    names += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                total = np.tile(known.log_prior, (b - a, 1))
                for k in range(len(known.langs)):
                    total[:, k] += np.bincount(owner, known.log_prob[bucket, k], minlength=b - a)
                total -= total.max(axis=1, keepdims=True)
                share = np.exp(total)
                share /= share.sum(axis=1, keepdims=True)
                best = share.argmax(axis=1)
                has = letters > 0
                names += [known.langs[k] if ok else UNKNOWN for k, ok in zip(best, has)]
                scores += np.where(has, share[np.arange(b - a), best], 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, PREDICTIONS)
