"""What several operators of this subpackage share: splits, labels, batches of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.session import shared_folder

#: Characters of text worked on at once inside a task; longer texts are taken alone.
BATCH_CHARS = 500_000
#: Rows whose texts a task holds as strings at once.
PIECE_ROWS = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Computed once and kept in the folder that all executors share, cut off its lineage.

    Spark removes the files when nothing refers to them any more, if it is told to clean
    checkpoints.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))) % folds


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, label 0/1): null ids and labels dropped, the larger label of repeated ids."""
    given = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("int").alias("label")
    )
    return given.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.max("label").alias("label")
    )


def label_sample(labels: DataFrame, name: str, keep: Column, bound: int) -> DataFrame:
    """At most about ``bound`` labelled ids that satisfy ``keep``, chosen by a hash of the id.

    The chosen share is ``bound`` over the number of eligible rows, so the sample is the
    same on every run and its size does not grow with the table. It never decides about
    documents, it only fits a model.
    """
    eligible = one_label(labels, name).where(keep)
    rows = eligible.count()
    if rows <= bound:
        return eligible
    share = int(bound / rows * 1_000_000)
    return eligible.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < share)


def labelled_texts(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of a bounded sample, one row per id: the ids are broadcast.

    Of several texts under one id the least is taken, first within each task, so no more
    texts than ids times tasks move and the bound on ids is one on rows.
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    held = texts.join(F.broadcast(sample), "doc_id")
    return held.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def slices(texts: list[str], limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` characters, or one longer text."""
    return ranges(list(map(len, texts)), limit)


def ranges(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive sizes whose sum is at most ``limit``, or one larger size."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of the texts as one array, and where each text begins and the last ends."""
    ends = np.cumsum([0, *map(len, texts)])
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), ends


def sums_between(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each text; 0 for an empty one."""
    running = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return running[ends[1:]] - running[ends[:-1]]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into few rows each, so that only these become Python strings at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    return ["" if x is None else x for x in batch.column(name).to_pylist()]


def keep_rows(documents: DataFrame, keep) -> DataFrame:
    """The documents for which ``keep(texts)`` is true, with all their columns, in place.

    ``keep`` takes a list of texts and returns as many flags; nothing is moved or joined.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield batch.filter(pa.array(keep(strings(batch, "text")), pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finishing step that spreads every bit of a 64-bit hash over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
