"""Whitening of vectors by polarisation: covariances from sums of squares, all in whole numbers.

A vector becomes whole numbers x = floor(64 c) + 1000000. The fit looks at each distinct x
once. Tasks add up the squares of every centred dimension and of every sum of two centred
dimensions; since Var(a + b) - Var(a) - Var(b) = 2 Cov(a, b), the differences give every
covariance. Dimensions are centred by the whole number next to their mean, and what is left
of the mean is taken out exactly, so no digit is lost however far the values lie from zero.
Only then is a division made, and the matrix of d x d numbers goes to ``eigh``.

What reaches the driver is d (d + 1) / 2 sums for vectors of d dimensions, whatever their
number. The only shuffle of vectors is the one that finds the distinct ones; a vector that
stands in a third of the rows is one row a task there.

Left out: null vectors, empty ones, those with null or non-finite components, and, if
lengths differ, all but those of the most frequent length among the distinct ones (of
equally frequent ones the greatest). Null ids and repeated rows stay, each row for itself. A
direction without variance has no component: one distinct vector alone, or an empty table,
gives no row. A component whose x is beyond 64 bits is an error. Columns other than id and
vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import materialise

# Components are kept in steps of 1/64, moved up by this much.
STEPS, MOVED = 64, 1_000_000
#: Components made at most.
COMPONENTS = 16
#: Numbers of a block that a task works on at once.
BLOCK = 1 << 19

#: Sums that travel in one row, and how many groups of tasks are added up before all are.
SUMS_A_ROW, TASK_GROUPS = 4096, 64

WHOLE, REAL = "decimal(38,0)", "double"


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening. ``error`` is how far the whitened fit list is from unit covariance."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    error: float = 0.0


def whole(vector: Column) -> Column:
    """x of a vector; null where the vector takes no part."""
    real = vector.cast("array<double>")
    bad = F.exists(real, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(real, lambda c: F.floor(c * F.lit(float(STEPS))) + F.lit(MOVED))
    return F.when(real.isNotNull() & (F.size(real) > 0) & ~bad, x)


def blocks(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of batches with the column of equally long lists as a matrix."""
    for batch in batches:
        if not batch.num_rows:
            continue
        width = len(batch.column(name).flatten()) // batch.num_rows
        rows = max(1, BLOCK // width)
        for start in range(0, batch.num_rows, rows):
            piece = batch.slice(start, rows)
            yield piece, piece.column(name).flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, width)


def exact(values: np.ndarray, bound: int) -> np.ndarray:
    """The values as they are if ``bound`` fits 64 bits, else as numbers of any size."""
    return values if bound < 1 << 62 else values.astype(object)


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max())))


def added(x: np.ndarray) -> np.ndarray:
    return exact(x, largest(x) * len(x)).sum(axis=0)


def squared(y: np.ndarray) -> np.ndarray:
    """For each pair of columns i < j the sum of (y_i + y_j)^2, and for i = j that of y_i^2."""
    y = exact(y, 4 * largest(y) ** 2 * len(y))
    width = y.shape[1]
    out = np.zeros((width, width), object)
    for i in range(width):
        out[i, i] = int((y[:, i] * y[:, i]).sum())
        pairs = y[:, i : i + 1] + y[:, i + 1 :]
        out[i, i + 1 :] = (pairs * pairs).sum(axis=0)
    return out


def _layout(kind: str) -> str:
    return f"task int, block int, totals array<{kind}>"


def _rows(totals, kind: str, task: int | None = None, block: int | None = None) -> pa.RecordBatch:
    """The sums of a task, some thousand to a row."""
    task = TaskContext.get().partitionId() % TASK_GROUPS if task is None else task
    starts = range(0, len(totals), SUMS_A_ROW)
    number = (lambda x: Decimal(int(x))) if kind == WHOLE else float
    value = pa.decimal128(38, 0) if kind == WHOLE else pa.float64()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([task] * len(starts), pa.int32()),
            pa.array([i if block is None else block for i in range(len(starts))], pa.int32()),
            pa.array([[number(x) for x in totals[i : i + SUMS_A_ROW]] for i in starts], pa.list_(value)),
        ],
        ["task", "block", "totals"],
    )


def _summed(partial: DataFrame, kind: str) -> list:
    """The sums of all tasks, place by place: first over groups of tasks, then over the groups.

    A task adds up row by row and holds the sums only, never the rows of all others.
    """

    def adding(keep_task: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for task, block, totals in zip(*(c.to_pylist() for c in batch.columns)):
                    row = np.array([int(t) for t in totals], object) if kind == WHOLE else np.array(totals)
                    key = (task if keep_task else 0, block)
                    held[key] = held[key] + row if key in held else row
            for (task, block), totals in held.items():
                yield _rows(totals, kind, task, block)

        return run

    groups = partial.repartition("task", "block").mapInArrow(adding(True), _layout(kind))
    rows = groups.repartition("block").mapInArrow(adding(False), _layout(kind)).collect()
    number = int if kind == WHOLE else float
    return [number(t) for r in sorted(rows, key=lambda r: r["block"]) for t in r["totals"]]


def first_sums(fit_list: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for _, x in blocks(batches, "x"):
            n += len(x)
            some = added(x).astype(object)
            total = some if total is None else total + some
        if n:
            yield _rows([n, *total], WHOLE)

    n, *sums = _summed(fit_list.mapInArrow(run, _layout(WHOLE)), WHOLE)
    return n, sums


def covariances(fit_list: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """n^2 times the covariance of every pair of dimensions, exactly."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    middle = np.array(centre, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in blocks(batches, "x"):
            some = squared(exact(x, largest(x) + int(np.abs(middle).max())) - middle)
            total = some if total is None else total + some
        if total is not None:
            yield _rows(total[np.triu_indices(len(total))], WHOLE)

    width = len(sums)
    pairs = zip(*(i.tolist() for i in np.triu_indices(width)))
    squares = dict(zip(pairs, _summed(fit_list.mapInArrow(run, _layout(WHOLE)), WHOLE)))
    rest = [s - n * c for s, c in zip(sums, centre)]
    alone = [n * squares[i, i] - rest[i] ** 2 for i in range(width)]
    out = [[0] * width for _ in range(width)]
    for i in range(width):
        out[i][i] = alone[i]
        for j in range(i + 1, width):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i][j] = out[j][i] = (both - alone[i] - alone[j]) // 2
    return out


def deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - S, exactly."""
    sums = np.array(model.sums, object)
    if model.n * largest(x) + largest(sums) < 1 << 62:
        return x * model.n - sums.astype(np.int64)
    return x.astype(object) * model.n - sums


def projected(away: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened components of vectors from their n x - S."""
    return (away / float(model.n)).astype(np.float64) @ (model.directions / np.sqrt(model.values))


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest entry by size of the covariance of the whitened fit list minus the identity."""
    size = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for _, x in blocks(batches, "x"):
            w = projected(deviations(x, model), model)
            total[:size] += w.T @ w
            total[size] += w.sum(axis=0)
        yield _rows(total.ravel(), REAL)

    total = np.array(_summed(fit_list.mapInArrow(run, _layout(REAL)), REAL)).reshape(size + 1, size)
    mean = total[size] / model.n
    return float(np.abs(total[:size] / model.n - np.outer(mean, mean) - np.eye(size)).max())


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening learned from the distinct vectors; None if no direction has any variance."""
    distinct = vectors.select(whole(F.col(column)).alias("x")).where("x IS NOT NULL").distinct()
    distinct = materialise(distinct)
    lengths = distinct.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if usual is None:
        return None
    fit_list = distinct.where(F.size("x") == usual["length"])
    n, sums = first_sums(fit_list)
    spread = covariances(fit_list, n, sums)
    trace = sum(spread[i][i] for i in range(len(sums)))
    if trace == 0:
        return None
    # Division of whole numbers of any size is rounded once, and correctly.
    matrix = np.array([[c / (n * n) for c in row] for row in spread])
    values, directions = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    values, directions = values[order], directions[:, order]
    real = values > len(sums) * np.finfo(np.float64).eps * values[0]
    values, directions = values[real], np.ascontiguousarray(directions[:, real])
    model = Whitening(n, tuple(sums), directions, values, values / (trace / (n * n)))
    return Whitening(n, model.sums, directions, values, model.explained, identity_error(fit_list, model))


def transform(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, deviation, whitened) of every vector that takes part.

    ``deviation`` is the sum over dimensions of (n x - S)^2, a whole number of up to 38
    digits; ``whitened`` holds one number per component.
    """
    rows = vectors.select(F.col(key), whole(F.col(column)).alias("x")).where("x IS NOT NULL")
    out = f"{key} {rows.schema[key].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>"
    if model is None:
        return rows.where("false").select(
            key, F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")
        )
    rows = rows.where(F.size("x") == len(model.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in blocks(batches, "x"):
            away = deviations(x, model)
            wide = away if largest(away) ** 2 * away.shape[1] < 1 << 62 else away.astype(object)
            squares = (wide * wide).sum(axis=1)
            if squares.dtype == object:
                deviation = pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0))
            else:
                deviation = pa.array(squares).cast(pa.decimal128(38, 0))
            w = projected(away, model)
            ends = np.arange(0, w.size + 1, w.shape[1], dtype=np.int32)
            whitened = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([piece.column(key), deviation, whitened], [key, "deviation", "whitened"])

    return rows.mapInArrow(run, out)


def components(whitened: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per transformed vector and component, with what the fit says of the component."""
    key = whitened.columns[0]
    explained = [float(e) for e in model.explained] if model else []
    return whitened.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else None).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(e) for e in explained]).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(model.error if model else None).cast("double").alias("identity_error"),
    )
