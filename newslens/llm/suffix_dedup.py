"""Passages that repeat, by sparse suffixes at content-selected places.

A passage is ``PASSAGE`` words in a row. Of the ``ANCHOR``-word beginnings of the suffixes
inside each passage the one with the least hash is its anchor, so that two equal passages
have equal anchors at the same place, and only about one suffix in thirteen is kept.
The kept suffixes are grouped by a hash of their beginnings, which replaces the sort of a
suffix array, and those whose beginning stands elsewhere too are extended to the left and right, over all passages that belong to the anchor.
If all suffixes with that beginning extend to the same words, they are settled as a whole;
otherwise passages with equal words are found by their hashes, one by one. Overlapping
repeated passages of a document join into one span, as long as the repetition is.

The occurrence in the document with the least id, and there the first one, is kept; all
others are to be removed. Texts that are equal as a whole are taken once; their copies
are spans from end to end. Of rows that repeat id and text one counts as the first; the
others are copies of it, each a span from end to end.

Defined cases: null and empty texts and texts of fewer words than a passage have no spans;
a document without an id is reported under a number from 2^62 on, made from its text; under a
repeated id each text counts for itself and has its own spans, and of two of them that hold a
passage the one with the lesser text hash is the first; a passage that overlaps its own
repetition is kept once; an empty table gives no rows; extra columns are kept by
``remove_repeats`` and ignored by the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newslens.llm.common import materialise, mix64, pieces, slices, strings
from newslens.llm.words import run_hashes, span_hashes, word_hashes

PASSAGE = 50
ANCHOR = 25
#: Texts with copies are broadcast up to this number, else shuffled.
BROADCAST_TEXTS = 1_000_000
#: Parts over which rows that repeat id and text are dealt.
SALTS = 64
#: Suffixes from which on a beginning is frequent, and the most frequent beginnings that are sent to all tasks.
FREQUENT, FREQUENT_BEGINNINGS = 1_000, 100_000
#: Suffixes that begin inside a passage.
INSIDE = PASSAGE - ANCHOR + 1

ANCHORS = "id long, whole long, words int, first int, last int, keys array<long>, regions array<long>, places array<int>"
PASSAGES = "passage long, id long, whole long, start int, end int, again int, first_id long"
# What a passage is within its own document: alone, the first of several, a later one.
# If the document as a whole has copies, none of its passages is alone. SETTLED marks all
# passages of an anchor as one, whose first document is known, in that document; the number
# after it in all others.
ALONE, FIRST, LATER, SETTLED = 0, 1, 2, 3


def _keys() -> tuple[Column, Column]:
    """The id, or a number made from the text, and a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), made), F.xxhash64(text, F.length(text))


def _with_id(documents: DataFrame) -> DataFrame:
    """(id, whole, text): ``whole`` is a hash of the text."""
    number, whole = _keys()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(number.alias("id"), whole.alias("whole"), text.alias("text"))


def anchor_of_passages(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all beginnings, and for each passage of one text the place of its anchor."""
    beginnings = run_hashes(words, ANCHOR)
    if len(words) < PASSAGE:
        return beginnings, np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(beginnings, INSIDE)
    return beginnings, views.argmin(axis=1) + np.arange(len(views))


def region_of_anchors(words: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each anchor's place, its first and last passage, and a hash of all words of these."""
    places, first = np.unique(anchors, return_index=True)
    last = np.append(first[1:], len(anchors)) - 1
    # The words of a region and where the anchor stands in it.
    size = last - first + PASSAGE
    region = span_hashes(words, first, size) if len(places) else np.zeros(0, np.uint64)
    return places, first, last, mix64(region + (places - first).astype(np.uint64))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    texts = strings(batch, "text")
    for a, b in slices(texts):
        hashes, first, last, borders = word_hashes(texts[a:b])
        for k in range(b - a):
            own = slice(borders[k], borders[k + 1])
            yield a + k, hashes[own], first[own], last[own]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        words, starts, ends, keys, regions, places = [], [], [], [], [], []
        for _, hashes, first, last in _texts(batch):
            beginnings, anchors = anchor_of_passages(hashes)
            own, _, _, region = region_of_anchors(hashes, anchors)
            words.append(len(hashes))
            starts.append(int(first[0]) if len(first) else 0)
            ends.append(int(last[-1]) if len(last) else 0)
            keys.append(beginnings[own].view(np.int64))
            regions.append(region.view(np.int64))
            places.append(own.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("whole"),
                pa.array(words, pa.int32()),
                pa.array(starts, pa.int32()),
                pa.array(ends, pa.int32()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(regions, pa.list_(pa.int64())),
                pa.array(places, pa.list_(pa.int32())),
            ],
            ["id", "whole", "words", "first", "last", "keys", "regions", "places"],
        )


def _frequent(groups: DataFrame) -> list:
    """The groups of the beginnings that most suffixes share, in order of their keys.

    The line rises with the number of suffixes, so there are never more than
    ``FREQUENT_BEGINNINGS``, however large the table is; all others are left to the join.
    """
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    line = max(FREQUENT, total // FREQUENT_BEGINNINGS + 1)
    return groups.where(F.col("n") >= line).orderBy("key").select("key", "least.id", "least.whole").collect()


SPLIT = "id long, whole long, copied boolean, wanted array<struct<place:int,first_id:long,is_first:boolean>>, rest array<struct<key:long,place:int>>"


def _split(frequent: list):
    """Per text the anchors with a frequent beginning, settled at once, and the rest."""
    known = np.array([g["key"] for g in frequent], np.int64)
    least = pa.array([g["id"] for g in frequent], pa.int64())
    least_whole = pa.array([g["whole"] for g in frequent], pa.int64())

    def parts(flags: np.ndarray, owner: np.ndarray, rows: int) -> pa.Array:
        return pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[flags], minlength=rows)))), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            keys, places = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("keys", "places"))
            owner = np.repeat(np.arange(n), pc.list_value_length(batch.column("keys")).to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[at] == keys
            group = pa.array(at[hit])
            whole = batch.column("whole").take(pa.array(owner[hit]))
            wanted = pa.StructArray.from_arrays(
                [pa.array(places[hit], pa.int32()), least.take(group), pc.equal(least_whole.take(group), whole)],
                ["place", "first_id", "is_first"],
            )
            rest = pa.StructArray.from_arrays(
                [pa.array(keys[~hit], pa.int64()), pa.array(places[~hit], pa.int32())], ["key", "place"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("whole"), batch.column("copied"),
                    pa.ListArray.from_arrays(parts(hit, owner, n), wanted), pa.ListArray.from_arrays(parts(~hit, owner, n), rest),
                ],
                ["id", "whole", "copied", "wanted", "rest"],
            )

    return run


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages around the anchors that have an equal elsewhere, with their characters.

    ``wanted`` holds for each such anchor its place and, if it is settled as a whole, the
    least id among the documents that hold it and whether this document is the first of them.
    """
    for batch in pieces(batches):
        ids, wholes, copied = (batch.column(c).to_pylist() for c in ("id", "whole", "copied"))
        wanted = batch.column("wanted")
        borders, asked = wanted.offsets.to_numpy(), wanted.values.field("place").to_numpy(zero_copy_only=False)
        least = wanted.values.field("first_id")
        settled = least.is_valid().to_numpy(zero_copy_only=False)
        least = least.fill_null(0).to_numpy(zero_copy_only=False)
        heads = wanted.values.field("is_first").fill_null(False).to_numpy(zero_copy_only=False)
        for k, hashes, first, last in _texts(batch):
            beginnings, anchors = anchor_of_passages(hashes)
            places, begin, end, _ = region_of_anchors(hashes, anchors)
            part = slice(borders[k], borders[k + 1])
            # Whole regions of settled anchors; of equal ones in one document the first.
            mine, head, is_first = (x[part][settled[part]] for x in (asked, least, heads))
            order = np.argsort(mine, kind="stable")
            own, head, is_first = np.searchsorted(places, mine[order]), head[order], is_first[order]
            earliest = np.zeros(len(own), bool)
            earliest[np.unique(beginnings[places[own]], return_index=True)[1]] = True
            document = mix64(np.array([ids[k]], np.int64).view(np.uint64)) + np.array([wholes[k]], np.int64).view(np.uint64)
            regions = mix64(document * np.uint64(31) + begin[own].astype(np.uint64)).view(np.int64)
            # Passages of the other anchors, one by one.
            at = np.flatnonzero(np.isin(anchors, asked[part][~settled[part]]))
            passages = run_hashes(hashes, PASSAGE)[at].view(np.int64)
            _, unique_at, inverse, counts = np.unique(passages, return_index=True, return_inverse=True, return_counts=True)
            first_of = np.zeros(len(at), bool)
            first_of[unique_at] = True
            again = np.where(counts[inverse] == 1, FIRST if copied[k] else ALONE, np.where(first_of, FIRST, LATER))
            starts, ends = np.concatenate((begin[own], at)), np.concatenate((end[own], at)) + PASSAGE - 1
            if not len(starts):
                continue
            state = np.concatenate((np.where(earliest & is_first, SETTLED, SETTLED + 1), again)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((regions, passages)), pa.int64()),
                    pa.array(np.full(len(starts), ids[k], np.int64)),
                    pa.array(np.full(len(starts), wholes[k], np.int64)),
                    pa.array(first[starts].astype(np.int32)),
                    pa.array(last[ends].astype(np.int32)),
                    pa.array(state),
                    pa.array(np.concatenate((head, np.zeros(len(at), np.int64))), pa.int64(), mask=np.arange(len(starts)) >= len(own)),
                ],
                ["passage", "id", "whole", "start", "end", "again", "first_id"],
            )


def _joined(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching (start, end) of the same keys as one."""
    along = W.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(W.unboundedPreceding, -1))
    begun = spans.withColumn("opens", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
    numbered = begun.withColumn("number", F.sum("opens").over(along.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "number").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_id").alias("first_doc_id")
    ).drop("number")


def _spans(documents: DataFrame) -> DataFrame:
    """(id, whole, extra, start, end, kept, first_doc_id): the spans of each text.

    ``extra`` spans are those of the rows beyond the first that repeat id and text.
    """
    texts = _with_id(documents)
    anchored = materialise(texts.mapInArrow(_anchors, ANCHORS))
    # One document for each whole text; the others are copies. Only texts that have copies are
    # looked up, so that the anchors of all others stay where they are.
    long = anchored.where(F.col("words") >= PASSAGE)
    rows = long.groupBy("whole", "id").agg(F.count(F.lit(1)).alias("rows"))
    wholes = rows.groupBy("whole").agg(F.min(F.struct("id", "rows")).alias("least"), F.sum("rows").alias("n"))
    wholes = wholes.where("n > 1").select("whole", F.col("least.id").alias("head"), F.col("least.rows").alias("head_rows"), "n")
    wholes = materialise(wholes)
    few = wholes.count() <= BROADCAST_TEXTS
    marked = long.join(F.broadcast(wholes) if few else wholes, "whole", "left")
    marked = marked.withColumns({"copies": F.coalesce("n", F.lit(1)), "head": F.coalesce("head", "id")}).drop("n")
    copies = marked.where((F.col("copies") > 1) & (F.col("id") != F.col("head")))
    # Rows that repeat the first one of a text are no heads of their own.
    several_rows = marked.where((F.col("head_rows") > 1) & (F.col("id") == F.col("head"))).dropDuplicates(["id", "whole"])
    heads = marked.where((F.col("id") == F.col("head")) & (F.coalesce("head_rows", F.lit(1)) == 1)).unionByName(several_rows)
    # Suffixes by their beginnings; those that have an equal one, or stand in a copied text.
    copied = (F.col("copies") > 1).alias("copied")
    suffixes = heads.select("id", "whole", copied, F.explode(F.arrays_zip("keys", "regions", "places")).alias("s")).select(
        "id", "whole", "copied", F.col("s.keys").alias("key"), F.col("s.regions").alias("region"), F.col("s.places").alias("place")
    )
    groups = suffixes.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("region").alias("low"), F.max("region").alias("high"),
        F.min(F.struct("id", "whole")).alias("least"), F.max(F.col("copied").cast("int")).alias("any_copied"),
    )
    groups = groups.where("n > 1 OR any_copied = 1").select(
        "key", "n", F.when(F.col("low") == F.col("high"), F.col("least")).alias("least")
    )
    # Kept, so that the join below has a plain table on either side. A beginning that very many
    # suffixes share is looked up within its texts: its suffixes never meet in one task.
    groups = materialise(groups)
    frequent = _frequent(groups)
    # The head of a text is one document, so its hash tells whether it is the first.
    place = F.struct("place", F.col("least.id").alias("first_id"), (F.col("least.whole") == F.col("whole")).alias("is_first"))
    if frequent:
        texts_split = heads.select("id", "whole", copied, "keys", "places").mapInArrow(_split(frequent), SPLIT)
        suffixes = texts_split.select("id", "whole", "copied", F.inline("rest"))
    found_once = suffixes.join(groups.drop("n"), "key").groupBy("id", "whole").agg(
        F.collect_list(place).alias("wanted"), F.first("copied").alias("copied")
    )
    wanted = found_once
    if frequent:
        at_once = texts_split.where(F.size("wanted") > 0).select("id", "whole", "wanted", "copied")
        wanted = found_once.unionByName(at_once).groupBy("id", "whole").agg(
            F.flatten(F.collect_list("wanted")).alias("wanted"), F.first("copied").alias("copied")
        )
    # Made twice below, once for each use: that costs less than keeping it.
    found = texts.join(wanted, ["id", "whole"]).select("id", "whole", "text", "wanted", "copied").mapInArrow(_extend, PASSAGES)
    holders = found.where(F.col("again") < LATER).groupBy("passage").agg(
        F.min(F.struct("id", "whole")).alias("least"), F.count(F.lit(1)).alias("n")
    )
    several = holders.where("n > 1").select("passage", "least")
    known = found.join(several, "passage", "left").where("least IS NOT NULL OR again <> 0")
    first = F.coalesce("first_id", "least.id", "id")
    is_first = (F.col("again") < LATER) & F.coalesce(F.col("least.whole") == F.col("whole"), F.lit(True))
    kept = ((F.col("again") == SETTLED) | is_first).alias("kept")
    spans = known.select("id", "whole", F.lit(False).alias("extra"), kept, "start", "end", first.alias("first_id"))

    def from_end_to_end(rows: DataFrame, extra: bool) -> DataFrame:
        return rows.select(
            "id", "whole", F.lit(extra).alias("extra"), F.lit(False).alias("kept"), F.col("first").alias("start"), F.col("last").alias("end"), F.col("head").alias("first_id")
        )

    every = spans.unionByName(from_end_to_end(copies, False)).unionByName(from_end_to_end(several_rows, True))
    return _joined(every, ["id", "whole", "extra", "kept"])


def repeated_passages(documents: DataFrame) -> DataFrame:
    """(doc_id, start, end, kept, first_doc_id): spans of characters that also stand elsewhere.

    ``kept`` tells the first occurrence from those to be removed (under an id whose row is
    repeated both, of different rows); ``first_doc_id`` is the least id among the documents that hold a passage of the span.
    """
    return _spans(documents).select(F.col("id").alias("doc_id"), "start", "end", "kept", "first_doc_id")


def without(text: str, spans: str) -> Column:
    """The text without sorted, disjoint spans of characters."""
    return F.expr(
        f"array_join(transform(sequence(0, size({spans})), i -> substring({text}, "
        f"if(i = 0, 0, {spans}[i - 1].end) + 1, "
        f"if(i = size({spans}), char_length({text}), {spans}[i].start) - if(i = 0, 0, {spans}[i - 1].end))), '')"
    )


def _one_first(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows with a flag that is true for one row of each key.

    A key that holds very many rows is first dealt over ``SALTS`` parts; only the first of
    each part compete in the end.
    """
    dealt = rows.withColumn("part_of_key", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    order = F.lit(1)
    dealt = dealt.withColumn("place_in_part", F.row_number().over(W.partitionBy(*keys, "part_of_key").orderBy(order)))
    part = F.when(F.col("place_in_part") == 1, -1).otherwise(F.col("part_of_key"))
    dealt = dealt.withColumn("part_of_key", part)
    place = F.row_number().over(W.partitionBy(*keys, "part_of_key").orderBy(order))
    return dealt.withColumn(name, (F.col("place_in_part") == 1) & (place == 1)).drop("part_of_key", "place_in_part")


def remove_repeats(documents: DataFrame) -> DataFrame:
    """The documents, with every repeated passage but its first occurrence cut out.

    ``n_chars`` follows the text if there is such a column; all other columns stay.
    """
    cut = _spans(documents).where(~F.col("kept"))
    span = F.struct("start", "end")
    cuts = cut.groupBy(F.col("id").alias("id_to_cut"), F.col("whole").alias("text_to_cut")).agg(
        F.sort_array(F.collect_list(F.when(~F.col("extra"), span))).alias("first_to_cut"),
        F.sort_array(F.collect_list(F.when(F.col("extra"), span))).alias("rest_to_cut"),
    )
    number, whole = _keys()
    marked = documents.withColumns({"id_to_cut": number, "text_to_cut": whole})
    joined = marked.join(cuts, ["id_to_cut", "text_to_cut"], "left")
    repeated = F.coalesce(F.size("rest_to_cut") > 0, F.lit(False))
    once = joined.where(~repeated).withColumn("spans_to_cut", F.col("first_to_cut"))
    rest = _one_first(joined.where(repeated), ["id_to_cut", "text_to_cut"], "is_first_row")
    rest = rest.withColumn("spans_to_cut", F.when(F.col("is_first_row"), F.col("first_to_cut")).otherwise(F.col("rest_to_cut")))
    joined = once.unionByName(rest.drop("is_first_row"))
    nothing = F.coalesce(F.size("spans_to_cut") == 0, F.lit(True))
    left = F.when(nothing, F.col("text")).otherwise(without("text", "spans_to_cut"))
    columns = [left.alias("text") if c == "text" else F.col(c) for c in documents.columns]
    out = joined.select(*columns)
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
