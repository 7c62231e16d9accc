"""Token counts of documents in flat, unindexed streams of ids.

A flat file holds the ids of its documents one after the other, each document closed by a
separator id, and nothing that says where a document begins. It is read as blocks of a
fixed number of ids. Each block is searched for separators at once with numpy; a document
may begin in one block and end in another, or cover several. What a block must know of
those before it is the number of separators and the place after the last one: a prefix
scan over one small row per block gives both, first within runs of ``RUN`` blocks and then
over the runs, so that no task gets all blocks of a large file.

Defined cases: ids after the last separator of a file are a document of their own if there
are any (an unclosed end); a file without ids yields nothing; two separators in a row
enclose a document of no tokens; null payloads are empty blocks; blocks are taken in the
order of their numbers, gaps in which do not matter. Repeated (file, block) rows are an
error of the input and counted twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslens.llm import bpe
from newslens.llm.common import materialise, strings

#: Ids in a block.
BLOCK = 1 << 16
#: Blocks in a run of the prefix scan.
RUN = 4096
END_OF_DOCUMENT = "<|endoftext|>"
#: The id of that token in the vocabulary file.
SEPARATOR = 49407

BLOCKS = "file long, block long, tokens binary, doc_ids array<long>"


def token_blocks(documents: DataFrame, path: str) -> DataFrame:
    """Flat streams of the documents' ids, one stream a partition, in blocks of ``BLOCK`` ids.

    ``tokens`` holds little-endian 32-bit ids. ``doc_ids`` names the documents that end in a
    block, for those who want to put counts back beside ids; counting does not look at it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bpe.cache(path, bpe.id_bytes, specials=False)
        file, block = TaskContext.get().partitionId(), 0
        end = np.array([SEPARATOR], "<u4").tobytes()
        held, size, ending = [], 0, []  # bytes, their number, (place, doc_id) of separators

        def cut(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, ending, block
            data, at = b"".join(held), 0
            while size - at >= least and at < size:
                until = min(at + 4 * BLOCK, size)
                own = [d for place, d in ending if place <= until]
                ending = ending[len(own) :]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data[at:until]], pa.binary()), pa.array([own], pa.list_(pa.int64()))],
                    ["file", "block", "tokens", "doc_ids"],
                )
                block, at = block + 1, until
            held, size = [data[at:]], size - at
            ending = [(place - at, d) for place, d in ending]

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, (_, kept) in zip(ids, known.documents(strings(batch, "text"))):
                piece = b"".join(kept) + end
                held.append(piece)
                size += len(piece)
                ending.append((size, doc_id))
                if size >= 4 * BLOCK:
                    yield from cut(4 * BLOCK)
        yield from cut(1)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, BLOCKS)


def read_blocks(spark: SparkSession, path: str, id_bytes: int = 4) -> DataFrame:
    """Blocks of flat binary files of ids, as Spark reads them from any store.

    A file is one row of the reader, so files should be below a gigabyte each, as token
    shards are; the blocks are cut from it without Python.
    """
    size = BLOCK * id_bytes
    files = spark.read.format("binaryFile").load(path).select("path", "content", "length")
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))
    return (
        files.where("length > 0")
        .select("path", "content", F.explode(numbers).alias("block"))
        .select(
            F.col("path").alias("file"),
            "block",
            F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size)).alias("tokens"),
        )
    )


def _search(kind: str, separator: int, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places = [], []
            for payload in batch.column("tokens"):
                ids = np.frombuffer(payload.as_buffer() or b"", kind)
                sizes.append(len(ids))
                places.append(np.flatnonzero(ids == separator).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("block").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(places, pa.list_(pa.int64())),
                    *[batch.column(c) for c in carry],
                ],
                ["file", "block", "size", "places", *carry],
            )

    return run


def separator_scan(
    blocks: DataFrame, separator: int = SEPARATOR, kind: str = "<u4", carry: list[str] | None = None
) -> DataFrame:
    """One row per document: file, doc_index, first_token, n_tokens, block, place.

    ``block`` and ``place`` say where the document's separator stands: in which block, and
    the how many-th there; ``carry`` names columns of that block to keep. ``first_token``
    counts ids from the start of the file, separators included.
    """
    carry = carry or []
    types = dict(blocks.dtypes)
    extra = "".join(f", `{c}` {types[c]}" for c in carry)
    found = blocks.select("file", "block", "tokens", *carry).mapInArrow(
        _search(kind, separator, carry),
        f"file {types['file']}, block long, size long, places array<long>{extra}",
    )
    # A few numbers a block, used twice below: looked for once.
    found = materialise(found)
    run = F.floor(F.col("block") / RUN).alias("run")
    found = found.select("*", run, F.size("places").cast("long").alias("n"), F.try_element_at("places", F.lit(-1)).alias("tail"))
    # Within a run: ids, separators and the place after the last separator so far.
    before = W.partitionBy("file", "run").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    own = found.withColumns(
        {"ids_before": F.coalesce(F.sum("size").over(before), F.lit(0)), "docs_before": F.coalesce(F.sum("n").over(before), F.lit(0))}
    )
    own = own.withColumn("closed", F.last(F.col("ids_before") + F.col("tail") + 1, ignorenulls=True).over(before))
    # Over runs: the same of all runs before.
    runs = own.groupBy("file", "run").agg(
        F.sum("size").alias("run_ids"),
        F.sum("n").alias("run_docs"),
        F.max(F.col("ids_before") + F.col("tail") + 1).alias("run_closed"),
    )
    earlier = W.partitionBy("file").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumns(
        {"base": F.coalesce(F.sum("run_ids").over(earlier), F.lit(0)), "doc_base": F.coalesce(F.sum("run_docs").over(earlier), F.lit(0))}
    )
    runs = runs.withColumn("run_start", F.coalesce(F.last(F.col("base") + F.col("run_closed"), ignorenulls=True).over(earlier), F.lit(0)))
    later = W.partitionBy("file").orderBy(F.desc("run")).rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("is_last_run", F.count(F.lit(1)).over(later) == 0)
    placed = own.join(runs.select("file", "run", "base", "doc_base", "run_start", "is_last_run"), ["file", "run"])
    rest = W.partitionBy("file", "run").orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("is_last", F.col("is_last_run") & (F.count(F.lit(1)).over(rest) == 0))
    start = F.coalesce(F.col("base") + F.col("closed"), F.col("run_start"))
    offset = F.col("base") + F.col("ids_before")
    # The end of the file closes what no separator does; it counts only if ids stand there.
    ends = F.transform("places", lambda p: p + offset)
    ends = F.when(F.col("is_last"), F.concat(ends, F.array(offset + F.col("size")))).otherwise(ends)
    rows = placed.select(
        "file", "block", "n", *carry, (F.col("doc_base") + F.col("docs_before")).alias("docs"), start.alias("start"), ends.alias("ends"),
    )
    exploded = rows.select("file", "block", "n", *carry, "docs", "start", "ends", F.posexplode("ends").alias("place", "end"))
    first = F.when(F.col("place") == 0, F.col("start")).otherwise(F.col("ends")[F.col("place") - 1] + 1)
    return (
        exploded.withColumn("first_token", first)
        .withColumn("n_tokens", F.col("end") - F.col("first_token"))
        .where((F.col("place") < F.col("n")) | (F.col("n_tokens") > 0))
        .select("file", (F.col("docs") + F.col("place")).alias("doc_index"), "first_token", "n_tokens", "block", "place", *carry)
    )
