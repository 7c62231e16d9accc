"""Near-duplicate documents: fixed bands of MinHash signatures, then exact Jaccard.

A document is the set of its runs of five words. Documents with the same set are one node;
copies are counted, never paired. Each node has ``TREES`` paths, whose steps are MinHash
values. Two sets of likeness s share a path of d steps with probability s^d; d is the
same for all data: the most steps, up to ``LONGEST``, with which two sets exactly at the
threshold share some path with probability ``RECALL`` or more. This stands in for a forest
of sorted tries, whose prefixes would be shortened where too few meet. Nodes that
stand together under a prefix are linked to one of them, not with each other, and linked
nodes form clusters.

Within a cluster every pair of nodes is compared exactly. A cluster is cut into blocks of
a bounded number of runs and nodes; each pair of blocks is one unit of work, whose result is one row
per node, not per pair: the number of documents it is linked with there, and one node that
it is connected with. A task counts shared runs for a strip of nodes at a time. So no pair is ever a row, a cluster of any size is spread over many
tasks, and no link within a cluster is lost; two sets that share no path are compared only
if other links bring them into one cluster.

Defined cases: null, empty and blank texts are copies of one another; any other text without
a word (of symbols only) is like no other but those that differ from it in white space
alone; a text shorter than a run is one run; rows with a null or repeated id keep
their own rows (a null id never names a class unless all ids of the class are null); an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import materialise, mix64, pieces, slices, strings
from newslens.llm.components import components
from newslens.llm.words import shingles, word_hashes

RUN = 5
THRESHOLD = 0.8
TREES = 40
LONGEST = 12
RECALL = 0.995
#: Runs of words in a block of a cluster, about.
BLOCK_RUNS = 300_000
#: Nodes in a block of a cluster, about.
BLOCK_NODES = 2000
#: Bytes of runs that a task puts into one batch.
BLOCK_BYTES = 8 << 20
#: Runs shared by more nodes of a block pair than this are counted by matrix products.
FEW = 8
#: Pairs of nodes whose shared runs are counted at once.
STRIP = 2_000_000
#: Runs that are columns of a matrix product at once.
COLUMNS = 1024

SIGNATURES = "doc_id long, id long, whole long, node long, size int, paths array<long>"
BLOCKS = "unit long, cluster long, i int, j int, block int, node long, copies long, runs binary"
LINKS = "cluster long, node long, root long, links long"


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The longest prefix at which two sets at the threshold meet often enough."""
    length = LONGEST
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


def _hash_family(size: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(20_240_501))
    odd = random.integers(0, 1 << 32, size, np.uint32) | np.uint32(1)
    return random.integers(0, 1 << 32, size, np.uint32), odd


def minhash(runs: np.ndarray, masks: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """The least value of each hash over the runs."""
    least = np.full(len(masks), 0xFFFFFFFF, np.uint32)
    short = (runs >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        values = (short[at : at + 2048] ^ masks[:, None]) * odds[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def node_of(runs: np.ndarray) -> int:
    """A number for the whole set."""
    total = mix64(runs).sum(dtype=np.uint64) if len(runs) else np.uint64(0)
    both = np.array([total + np.uint64(len(runs))], np.uint64)
    return int(mix64(both).view(np.int64)[0])


def node_of_text(text: str, runs: np.ndarray) -> int:
    """The number of the text's set; of the text itself, but for white space, if it has no word."""
    written = "" if len(runs) else " ".join(text.split())
    if not written:
        return node_of(runs)
    return int.from_bytes(hashlib.blake2b(written.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def path_keys(least: np.ndarray, trees: int) -> np.ndarray:
    """One number per trie for the prefix found there."""
    steps = least.reshape(trees, -1).astype(np.uint64)
    keys = np.arange(1, trees + 1, dtype=np.uint64)
    for k in range(steps.shape[1]):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + steps[:, k])
    return keys.view(np.int64)


def _keys() -> tuple[Column, Column]:
    """An id, which a document without one gets as a number from 2^62 on from its text; the text's hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), made), F.xxhash64(text, F.length(text))


def _with_id(documents: DataFrame) -> DataFrame:
    """(doc_id, id, whole, text)."""
    number, whole = _keys()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("id"), whole.alias("whole"), text.alias("text"))


def _runs_of(texts: list[str]) -> Iterator[np.ndarray]:
    for a, b in slices(texts):
        hashes, _, _, borders = word_hashes(texts[a:b])
        for k in range(b - a):
            yield shingles(hashes[borders[k] : borders[k + 1]], RUN)


def signatures(documents: DataFrame) -> DataFrame:
    """Per document its node, the size of its set and its path in each trie."""
    length = prefix_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, odds = _hash_family(TREES * length)
        for batch in pieces(batches):
            nodes, sizes, paths = [], [], []
            texts = strings(batch, "text")
            for text, runs in zip(texts, _runs_of(texts)):
                nodes.append(node_of_text(text, runs))
                sizes.append(len(runs))
                paths.append(path_keys(minhash(runs, masks, odds), TREES) if len(runs) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("id"),
                    batch.column("whole"),
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(paths, pa.list_(pa.int64())),
                ],
                ["doc_id", "id", "whole", "node", "size", "paths"],
            )

    return _with_id(documents).mapInArrow(run, SIGNATURES)


def clusters(nodes: DataFrame) -> DataFrame:
    """(node, cluster) of the nodes that share a prefix with another one."""
    keys = nodes.select("node", F.explode("paths").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b <> most")
    links = keys.join(shared.select("key", "b"), "key").where("node <> b")
    return components(links.select(F.col("node").alias("a"), "b")).withColumnRenamed("root", "cluster")


def _unit(cluster: int, i: int, j: int) -> int:
    """One number for a pair of blocks, to spread units over tasks."""
    mask = (1 << 64) - 1
    value = ((cluster & mask) * 0x9E3779B97F4A7C15 + i * 0xD6E8FEB86659FD93 + j * 0xC2B2AE3D27D4EB4F) & mask
    return (value ^ (value >> 31)) - (1 << 63)


def block_pairs(documents: DataFrame, members: DataFrame) -> DataFrame:
    """The runs of each node, once for every pair of blocks that its own is part of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["unit", "cluster", "i", "j", "block", "node", "copies", "runs"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in pieces(batches):
            rows = batch.select(["node", "cluster", "copies", "block", "blocks"]).to_pylist()
            out: list[tuple] = []
            held = 0
            for row, runs in zip(rows, _runs_of(strings(batch, "text"))):
                if node_of(runs) != row["node"]:  # another text under a repeated id
                    continue
                data, own = runs.tobytes(), row["block"]
                for other in range(row["blocks"]):
                    i, j = min(own, other), max(own, other)
                    out.append((_unit(row["cluster"], i, j), row["cluster"], i, j, own, row["node"], row["copies"], data))
                    held += len(data)
                    if held > BLOCK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    texts = _with_id(documents).select("id", "whole", "text")
    # Other texts under the same id are other nodes; one text under one id twice counts once.
    joined = texts.join(members, ["id", "whole"])
    return joined.select("text", "node", "cluster", "copies", "block", "blocks").mapInArrow(run, BLOCKS)


class Held:
    """The runs that several of the sets hold, and who holds them."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.n = n = len(sets)
        owner = np.repeat(np.arange(n), [len(s) for s in sets])
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
        held = np.diff(np.append(starts, len(values)))
        # Each ordered pair of holders of a run that few hold, as one number.
        pairs = []
        for c in range(2, min(FEW, n) + 1):
            rows = owner[starts[held == c][:, None] + np.arange(c)]
            pairs += [rows[:, a] * n + rows[:, b] for a in range(c) for b in range(c) if a != b]
        self.pairs = np.sort(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        # Holders and columns of the runs that many hold.
        many = np.flatnonzero(held > FEW)
        self.parts = []
        for at in range(0, len(many), COLUMNS):
            part = many[at : at + COLUMNS]
            column = np.repeat(np.arange(len(part)), held[part])
            places = np.repeat(starts[part], held[part]) + np.arange(len(column)) - np.repeat(np.cumsum(held[part]) - held[part], held[part])
            self.parts.append((owner[places], column, len(part)))

    def counts(self, a: int, b: int) -> np.ndarray:
        """How many elements the sets from ``a`` to ``b`` have in common with each set; its own size is left open."""
        n = self.n
        low, high = np.searchsorted(self.pairs, [a * n, b * n])
        counts = np.bincount(self.pairs[low:high] - a * n, minlength=(b - a) * n).reshape(b - a, n).astype(np.int32)
        for owner, column, width in self.parts:
            marks = np.zeros((n, width), np.float32)
            marks[owner, column] = 1
            counts += (marks[a:b] @ marks.T).astype(np.int32)
        return counts


def strips(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of a matrix of n x n with at most ``STRIP`` cells, or one row."""
    size = max(1, STRIP // max(1, n))
    for a in range(0, n, size):
        yield a, min(a + size, n)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets have in common."""
    held = Held(sets)
    return np.concatenate([held.counts(a, b) for a, b in strips(len(sets))])


def compare(rows: list[dict], threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
    """(node, root, linked documents) of the linked nodes of one pair of blocks."""
    rows = list({r["node"]: r for r in rows}.values())
    sets = [np.frombuffer(r["runs"], np.uint64) for r in rows]
    sizes = np.array([len(s) for s in sets])
    block = np.array([r["block"] for r in rows])
    apart = bool(rows) and rows[0]["i"] != rows[0]["j"]
    linked = np.zeros((len(rows), len(rows)), np.bool_)
    held = Held(sets)
    for a, b in strips(len(rows)):
        linked[a:b] = (1 + threshold) * held.counts(a, b) >= threshold * (sizes[a:b, None] + sizes[None, :]) - 1e-9
        if apart:
            linked[a:b] &= block[a:b, None] != block[None, :]
    np.fill_diagonal(linked, False)
    copies = np.array([r["copies"] for r in rows], np.int64)
    links = np.array([copies[own].sum() for own in linked], np.int64)
    order = np.argsort([r["node"] for r in rows], kind="stable")
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    while True:
        least = rank.copy()
        for a, b in strips(len(rows)):
            near = np.where(linked[a:b], rank[None, :], len(rows)).min(axis=1, initial=len(rows))
            np.minimum(rank[a:b], near, out=least[a:b])
        if (least == rank).all():
            break
        rank = least
    return [(r["node"], rows[order[k]]["node"], int(c)) for r, k, c in zip(rows, rank.tolist(), links) if c]


def _compare_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit, cluster and blocks; a unit is held until the next begins."""
    held: list[dict] = []
    key = None
    out: list[tuple] = []

    def finish() -> None:
        if len(held) > 1:
            out.extend((held[0]["cluster"], *found) for found in compare(held))

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "node", "root", "links"])

    for batch in batches:
        for row in batch.to_pylist():
            own = row["unit"], row["cluster"], row["i"], row["j"]
            if own != key:
                finish()
                held, key = [], own
            held.append(row)
        if len(out) > 5000:
            yield batch_of()
            out = []
    finish()
    yield batch_of()


def classes(documents: DataFrame) -> DataFrame:
    """(doc_id, id, whole, root, copies, n_links) of every row; equal roots are one class."""
    signed = materialise(signatures(documents))
    nodes = signed.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "whole")).alias("least"), F.first("size").alias("size"), F.first("paths").alias("paths")
    )
    nodes = materialise(nodes.select("node", "copies", "least.id", "least.whole", "size", "paths"))
    known = nodes.select("node", "id", "whole", "copies", "size")
    grouped = materialise(clusters(nodes.select("node", "paths")).join(known, "node"))
    needed = F.greatest(F.ceil(F.sum("size") / BLOCK_RUNS), F.ceil(F.count(F.lit(1)) / BLOCK_NODES))
    sizes = grouped.groupBy("cluster").agg(F.greatest(F.lit(1), needed).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    members = grouped.join(sizes, "cluster").select("id", "whole", "node", "cluster", "copies", block.alias("block"), "blocks")
    units = block_pairs(documents, members).repartition("unit").sortWithinPartitions("unit", "cluster", "i", "j")
    found = materialise(units.mapInArrow(_compare_units, LINKS))
    # In a cluster of one block the root is already the least node of its component.
    wide = found.join(sizes.where("blocks > 1").select("cluster"), "cluster", "left_semi")
    roots = components(wide.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("own"))
    linked = linked.join(roots, "node", "left").select("node", "links", F.coalesce("root", "own").alias("root"))
    own = signed.select("doc_id", "id", "whole", "node").join(nodes.select("node", "copies"), "node").join(linked, "node", "left")
    return own.select(
        "doc_id", "id", "whole", F.coalesce("root", "node").alias("root"), "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies): one row per document.

    ``class_id`` is the least id among the documents connected by likeness of at least
    ``THRESHOLD``, ``n_links`` the number of other documents that like this one,
    ``n_copies`` that of documents with the same set, itself included.
    """
    own = materialise(classes(documents))
    least = own.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return own.join(least, "root").select("doc_id", "class_id", "n_links", F.col("copies").alias("n_copies"))


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, with one of each class: that with the least id. All columns stay."""
    row = F.struct("id", "whole")
    kept = classes(documents).groupBy("root").agg(F.min(row).alias("row")).select(
        F.col("row.id").alias("kept_id"), F.col("row.whole").alias("kept_whole")
    )
    number, whole = _keys()
    marked = documents.withColumns({"kept_id": number, "kept_whole": whole})
    one = marked.join(kept, ["kept_id", "kept_whole"], "left_semi").dropDuplicates(["kept_id", "kept_whole"])
    return one.select(*documents.columns)
