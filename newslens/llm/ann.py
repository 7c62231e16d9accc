"""Approximate nearest neighbours by inner product, with balanced posting lists.

A bounded sample is halved again and again by two-means cuts at the median, which gives
lists of equal size; their means are the centroids. Inner products become distances by one
more dimension, which fills every vector up to the largest norm. A graph links each
centroid with its nearest ones, is held in memory by every task, and is walked from the
best centroid found so far. A vector goes into the list of its nearest centroid and, if it
stands near a border, into further lists whose distance is within a ratio; a query reads
all lists within a ratio of its nearest. That ratio is the least one with which, on the
sample, queries find ``RECALL`` of what brute force finds.

Equal vectors are one candidate that knows its least ids, so a vector that a third of all
rows hold is scored once. Long lists are cut into chunks and many queries into blocks;
each pair of them is one unit of work, whose size is bounded. Scores are inner products of
the original vectors in double precision.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part, nor do those whose length is not the most frequent one (the smaller of equal
ones); rows without an id take no part; a repeated id with the same vector is one row;
ties go to the smaller id; fewer candidates than asked for are all returned; an empty table
gives no rows; columns other than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import materialise

#: Vectors that the lists are learned from, and queries that the ratio is learned from, at most.
SAMPLE = 16_000
TRIALS = 300
#: Vectors of the sample in one list, about, and the most lists there are.
LIST_SIZE = 60
MAX_LISTS = 4096
#: Neighbours of a centroid in the graph.
DEGREE = 24
#: Lists that a vector may stand in, and how much farther than the nearest those may be.
COPIES = 4
BORDER = 1.15
RECALL = 0.97
RATIOS = (1.0, 1.02, 1.04, 1.06, 1.08, 1.1, 1.13, 1.16, 1.2, 1.25, 1.3, 1.4, 1.5, 2.0, 1e9)
#: Vectors of a list and queries that meet in one unit of work, at most about.
CHUNK = 4096

#: Queries whose best candidates a task holds before it gives them out.
HELD_QUERIES = 20_000

CANDIDATE, QUERY = 0, 1


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray  # lists x (dimension + 1)
    graph: np.ndarray  # lists x degree
    largest: float  # the largest squared norm
    ratio: float
    sizes: np.ndarray | None = None  # vectors in each list

    def raised(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """With one more component: what a vector lacks to the largest norm; nothing for a query."""
        if query:
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            return np.hstack([vectors / norms * np.sqrt(self.largest), np.zeros((len(vectors), 1))])
        rest = np.sqrt(np.maximum(self.largest - (vectors**2).sum(axis=1, keepdims=True), 0))
        return np.hstack([vectors, rest])

    def near(self, points: np.ndarray, ratio: float, least: int) -> np.ndarray:
        """Distances to the centroids that a walk of the graph finds; infinite for the others.

        Each step goes on from the nearest centroid not yet gone on from, for all points at
        once, until that is farther than ``ratio`` times the nearest and ``least`` steps
        are made.
        """
        count, lists = len(points), len(self.centroids)
        found = np.full((count, lists), np.inf)
        rows = np.arange(count)
        squares = (self.centroids**2).sum(axis=1)
        own = (points**2).sum(axis=1)

        def look(who: np.ndarray, where: np.ndarray) -> None:
            dots = np.einsum("ij,ikj->ik", points[who], self.centroids[where])
            square = own[who][:, None] + squares[where] - 2 * dots
            found[who[:, None], where] = np.sqrt(np.maximum(square, 0))

        starts = np.unique(np.linspace(0, lists - 1, min(lists, 16)).astype(int))
        look(rows, np.tile(starts, (count, 1)))
        open_to = found.copy()
        active = rows
        for step in range(lists):
            nearest = open_to[active].argmin(axis=1)
            distance = open_to[active, nearest]
            going = np.isfinite(distance)
            if step >= least:
                going &= distance <= ratio * found[active].min(axis=1)
            active, nearest = active[going], nearest[going]
            if not len(active):
                break
            open_to[active, nearest] = -1.0  # gone on from; made infinite below
            where = self.graph[nearest]
            new = ~np.isfinite(found[active[:, None], where])
            look(active, where)
            fresh = np.where(new, found[active[:, None], where], np.inf)
            old = open_to[active[:, None], where]
            open_to[active[:, None], where] = np.where(new, fresh, old)
            open_to[active, nearest] = np.inf
        return found


def halves(points: np.ndarray, rows: np.ndarray, size: int, random: np.random.Generator) -> list[np.ndarray]:
    """Lists of equal size: cut at the median between two means, again and again."""
    todo, done = [rows], []
    while todo:
        own = todo.pop()
        if len(own) <= size or len(own) < 2:
            done.append(own)
            continue
        part = points[own]
        means = part[random.choice(len(own), 2, replace=False)]
        for _ in range(6):
            side = ((part - means[0]) ** 2).sum(axis=1) > ((part - means[1]) ** 2).sum(axis=1)
            if side.all() or not side.any():
                break
            means = np.stack([part[~side].mean(axis=0), part[side].mean(axis=0)])
        order = np.argsort(part @ (means[1] - means[0]), kind="stable")
        middle = len(own) // 2
        todo += [own[order[:middle]], own[order[middle:]]]
    return done


def _graph(centroids: np.ndarray) -> np.ndarray:
    """The nearest centroids of each one, by blocks; the last two links lead far away."""
    lists = len(centroids)
    degree = min(DEGREE, max(1, lists - 1))
    squares = (centroids**2).sum(axis=1)
    out = np.zeros((lists, degree), np.int64)
    for at in range(0, lists, 512):
        part = centroids[at : at + 512]
        distance = squares[None, :] - 2 * part @ centroids.T
        distance[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
        out[at : at + 512] = np.argsort(distance, axis=1, kind="stable")[:, :degree]
    if lists > degree + 1 and degree > 4:
        far = np.arange(lists)
        out[:, -1], out[:, -2] = (far * 7 + 1) % lists, (far + 1) % lists  # every list can be reached
    return out


def learn(sample: np.ndarray, largest: float) -> Index:
    """Lists, graph and ratio from a sample of distinct vectors."""
    random = np.random.Generator(np.random.PCG64(7))
    raw = Index(np.zeros((1, 1)), np.zeros((1, 1), int), largest, 1.0)
    points = raw.raised(sample)
    size = max(2, LIST_SIZE, -(-len(points) // MAX_LISTS))
    lists = halves(points, np.arange(len(points)), size, random)
    centroids = np.stack([points[own].mean(axis=0) for own in lists])
    index = Index(centroids, _graph(centroids), largest, 1.0)
    stored = assign(index, sample)
    trial = random.permutation(len(sample))[:TRIALS]
    exact = sample[trial] @ sample.T
    exact[np.arange(len(trial)), trial] = -np.inf
    wanted = np.argsort(-exact, axis=1, kind="stable")[:, : min(20, len(sample) - 1)]
    if not wanted.size:
        return index
    distance = index.near(index.raised(sample[trial], query=True), RATIOS[-1], len(centroids))
    relative = distance / distance.min(axis=1, keepdims=True)
    member = np.zeros((len(sample), len(centroids)), bool)
    for who, where in stored:
        member[who, where] = True
    # A neighbour is found with the ratio of the nearest list, seen from the query, that has it.
    needed = np.array([[relative[i][member[j]].min() for j in row] for i, row in enumerate(wanted)])
    for ratio in RATIOS:
        if (needed <= ratio).mean() >= RECALL:
            break
    return Index(centroids, index.graph, largest, ratio)


def assign(index: Index, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (rows, lists): the nearest list of each vector and those it nearly stands in."""
    out = []
    for at in range(0, len(vectors), 256):
        distance = index.near(index.raised(vectors[at : at + 256]), 1.0, 12)
        order = np.argsort(distance, axis=1, kind="stable")[:, :COPIES]
        close = np.take_along_axis(distance, order, axis=1)
        chosen = close <= BORDER * close[:, :1]
        chosen[:, 0] = True
        who, k = np.nonzero(chosen)
        out.append((who + at, order[who, k]))
    return out


def select(index: Index, queries: np.ndarray, keep: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (rows, lists): the lists that each query reads.

    If those within the ratio may hold fewer than ``keep`` vectors, the next nearest ones
    are read too, as many as it takes.
    """
    enough = COPIES * keep  # a vector stands in at most so many lists
    out = []
    for at in range(0, len(queries), 256):
        points = index.raised(queries[at : at + 256], query=True)
        distance = index.near(points, index.ratio, 24)
        reached = np.isfinite(distance) @ index.sizes
        few = np.flatnonzero(reached < enough)
        if len(few):
            distance[few] = index.near(points[few], np.inf, len(index.centroids))
        order = np.argsort(distance, axis=1, kind="stable")
        sizes = np.where(np.isfinite(distance), index.sizes, 0)
        before = np.cumsum(np.take_along_axis(sizes, order, axis=1), axis=1) - np.take_along_axis(sizes, order, axis=1)
        needed = np.zeros(distance.shape, bool)
        np.put_along_axis(needed, order, before < enough, axis=1)
        chosen = np.isfinite(distance) & (needed | (distance <= index.ratio * distance.min(axis=1, keepdims=True)))
        who, where = np.nonzero(chosen)
        out.append((who + at, where))
    return out


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """(vec_id, vec): vectors that take part, as arrays of doubles of the most frequent length."""
    vec = F.col(column).cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id IS NOT NULL AND size(vec) > 0")
    rows = rows.where("forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vec, x -> x <> 0)")
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (lengths[0]["n"] if lengths else 0))


def _least_ids(keep: int, every: int):
    """Within a task: distinct vectors with their least ids, and whether one of them is a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list[int]] = {}
        asked: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            names = list(found)
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([found[n] for n in names], pa.list_(pa.int64())), pa.array([n in asked for n in names], pa.bool_())],
                ["vec", "ids", "asked"],
            )
            found.clear()
            asked.clear()
            return out

        for batch in batches:
            for vec_id, vec in zip(batch.column("vec_id").to_pylist(), batch.column("vec")):
                name = vec.values.to_numpy(zero_copy_only=False).astype("<f8").tobytes()
                ids = found.setdefault(name, [])
                if vec_id not in ids and (len(ids) < keep or vec_id < ids[-1]):
                    ids.append(vec_id)
                    ids.sort()
                    del ids[keep:]
                if vec_id % every == 0:
                    asked.add(name)
            if len(found) > 50_000:
                yield flush()
        yield flush()

    return run


def distinct_vectors(rows: DataFrame, keep: int, every: int) -> DataFrame:
    """(vec, ids, first, asked): each distinct vector once, with its ``keep`` least ids."""
    partial = rows.mapInArrow(_least_ids(keep, every), "vec binary, ids array<long>, asked boolean")
    ids = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return partial.groupBy("vec").agg(ids.alias("ids"), F.max("asked").alias("asked")).withColumn("first", F.col("ids")[0])


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1) if values else np.zeros((0, 0))


def _place(index, sides):
    """Rows (list, first, vec) of the lists that each vector stands in or each query reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            vectors = _matrix(batch.column("vec"))
            if not len(vectors):
                continue
            for who, where in sides(known, vectors):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where, pa.int32()), batch.column("first").take(pa.array(who)), batch.column("vec").take(pa.array(who))],
                    ["list", "first", "vec"],
                )

    return run


def _score(keep: int):
    """Units come sorted, candidates before queries; per query its best candidates of a task.

    What the units of a task find for one query is put together before it is given out, so
    a query yields a row per task and not one per list.
    """

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        ids, first = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
        scores = np.concatenate([p[1] for p in parts])[first]
        order = np.lexsort((ids, -scores))[:keep]
        return ids[order], scores[order]

    def best(unit: list[dict], fresh: list[dict]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ids = np.array([r["first"] for r in unit], np.int64)
        table = np.frombuffer(b"".join(r["vec"] for r in unit), "<f8").reshape(len(unit), -1)
        for at in range(0, len(fresh), 256):
            part = fresh[at : at + 256]
            scores = np.frombuffer(b"".join(r["vec"] for r in part), "<f8").reshape(len(part), -1) @ table.T
            kept = min(keep, len(unit))
            # All that tie with the last kept score stay in the running.
            edge = -np.partition(-scores, kept - 1, axis=1)[:, kept - 1]
            for k, row in enumerate(part):
                near = np.flatnonzero(scores[k] >= edge[k])
                near = near[np.lexsort((ids[near], -scores[k][near]))][:kept]
                yield row["first"], ids[near], scores[k][near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, unit, asked = None, [], []
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def finish() -> None:
            if unit and asked:
                for query, ids, scores in best(unit, asked):
                    parts = held.setdefault(query, [])
                    parts.append((ids, scores))
                    if len(parts) >= 16:
                        held[query] = [merged(parts)]

        def flush() -> pa.RecordBatch:
            found = [merged(parts) for parts in held.values()]
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int64()), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))],
                ["query", "firsts", "scores"],
            )
            held.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                own = row["list"], row["chunk"], row["block"]
                if own != key:
                    finish()
                    key, unit, asked = own, [], []
                    if len(held) > HELD_QUERIES:
                        yield flush()
                (unit if row["side"] == CANDIDATE else asked).append(row)
        finish()
        yield flush()

    return run


def search(vectors: DataFrame, column: str, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id ``every`` divides."""
    session = vectors.sparkSession
    rows = usable(vectors, column)
    keep = k + 1  # a query's own row is one of them
    nodes = materialise(distinct_vectors(rows, keep, every))
    count = nodes.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not count:
        return session.createDataFrame([], schema)
    sample = nodes.select("vec").orderBy(F.xxhash64("vec")).limit(SAMPLE).toArrow().column("vec").combine_chunks()
    largest = rows.agg(F.max(F.expr("aggregate(vec, 0d, (a, x) -> a + x * x)"))).head()[0]
    index = learn(_matrix(sample), float(largest))
    placed = "list int, first long, vec binary"
    stored = nodes.select("first", "vec").mapInArrow(_place(session.sparkContext.broadcast(index), assign), placed)
    stored = materialise(stored)
    # Sizes of the lists, a bounded number of them, say into how many units each is cut.
    held = stored.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    sizes = np.zeros(len(index.centroids), np.int64)
    for row in held.collect():
        sizes[row["list"]] = row["n"]
    shared = session.sparkContext.broadcast(replace(index, sizes=sizes))
    chosen = _place(shared, lambda known, points: select(known, points, keep))
    asked = materialise(nodes.where("asked").select("first", "vec").mapInArrow(chosen, placed))
    sizes = held.select("list", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    reads = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("blocks"))
    units = F.broadcast(sizes.join(reads, "list"))
    chunk, block = F.pmod(F.xxhash64("first"), F.col("chunks")), F.pmod(F.xxhash64("first"), F.col("blocks"))
    one = stored.join(units, "list").select(
        "list", chunk.cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block"),
        F.lit(CANDIDATE).alias("side"), "first", "vec",
    )
    other = asked.join(units, "list").select(
        "list", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))).alias("chunk"), block.cast("int").alias("block"),
        F.lit(QUERY).alias("side"), "first", "vec",
    )
    together = one.unionByName(other).repartition("list", "chunk", "block").sortWithinPartitions("list", "chunk", "block", "side", "first")
    scored = together.mapInArrow(_score(keep), "query long, firsts array<long>, scores array<double>")
    pairs = scored.select("query", F.explode(F.arrays_zip("firsts", "scores")).alias("p")).select(
        "query", F.col("p.firsts").alias("first"), F.col("p.scores").alias("score")
    )
    # A candidate that stands in several lists was scored several times, always alike.
    ids = nodes.select("first", "ids")
    best = _top(pairs.groupBy("query", "first").agg(F.max("score").alias("score")), "first", keep)
    found = best.select("query", F.explode("best").alias("b")).select("query", F.col("b.id").alias("first"), (-F.col("b.less")).alias("score"))
    each = found.join(ids, "first").select("query", "score", F.explode("ids").alias("id"))
    nearest = _top(each, "id", keep)
    return _answers(rows, nodes, nearest, k, every)


def _top(pairs: DataFrame, name: str, keep: int) -> DataFrame:
    """(query, best): the best few of each query, nearest first; ties to the smaller number."""
    row = F.struct((-F.col("score")).alias("less"), F.col(name).alias("id"))
    return pairs.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(row)), 1, keep).alias("best"))


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [v.values.to_numpy(zero_copy_only=False).astype("<f8").tobytes() for v in batch.column("vec")]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(names, pa.binary())], ["vec_id", "vec"])


def _answers(rows: DataFrame, nodes: DataFrame, nearest: DataFrame, k: int, every: int) -> DataFrame:
    """The answers of distinct query vectors, given to every query row that holds one of them."""
    askers = rows.where(F.col("vec_id") % every == 0).mapInArrow(_bytes_of, "vec_id long, vec binary").distinct()
    known = nodes.where("asked").select("vec", F.col("first").alias("query")).join(nearest, "query").select("vec", "best")
    own = askers.join(known, "vec").select(
        F.col("vec_id").alias("query_id"), F.expr(f"slice(filter(best, b -> b.id <> vec_id), 1, {k})").alias("best")
    )
    return own.select("query_id", F.posexplode("best").alias("place", "b")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.less")).alias("score")
    )
