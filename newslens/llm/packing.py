"""Packing of documents into sequences, in order, by dynamic programming.

The tokens of a partition's documents, in the order they are read, form one stream. It is
cut into windows of at most ``SEQUENCE`` tokens. A cut costs nothing between documents,
``SENTENCE_CUT`` after a sentence; a window costs the tokens it is padded with, none if
its length is a power of two. The cheapest cuts are found by dynamic programming: the
best predecessor of a position minimises cost + place over the positions less than a
window back, which a queue with rising values gives in constant time.
A stretch without a sentence end that is longer than a window may be cut inside at
``FORCED_CUT``.

Only a block of the stream is held at a time; the last window of a block goes on into the
next one. Partitions are independent, so a lost one is packed again on its own. The last
window of a partition is cut into lengths that are powers of two where that costs less
than its padding.

Defined cases: a null or empty text is one separator token; repeated or null ids are
packed like any other; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import bpe
from newslens.llm.common import ranges

SEQUENCE = 2048
#: The id that ends each document.
SEPARATOR = 1
SENTENCE_CUT = 4.0
FORCED_CUT = 64.0
#: What ends a sentence, in any script.
FULL_STOP = re.compile("[.!?\u0589\u061d\u061f\u06d4\u0700-\u0702\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u17d4\u17d5\u1803\u1809\u203c\u203d\u2047-\u2049\u3002\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61]")
#: Places offered in a stretch without a sentence end are so many tokens apart.
FORCED_STEP = 256
#: Tokens of the stream that are planned at once.
BLOCK = 400_000
#: Bytes of text that are cut and looked up at once; longer texts are taken alone.
SLICE_BYTES = 4_000_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length int"
)
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]


def padding(length: int) -> int:
    return 0 if length & (length - 1) == 0 else SEQUENCE - length


def best_cuts(places: np.ndarray, costs: np.ndarray) -> list[int]:
    """The cheapest chain of cuts from the first to the last of the rising ``places``.

    Neighbouring places must be at most ``SEQUENCE`` apart; the cost of the last one is not
    counted.
    """
    n = len(places)
    offsets = places - places[0]
    first = np.searchsorted(places, places - SEQUENCE).tolist()
    # Predecessors at a distance that is a power of two, which need no padding: those of j end at until[j].
    number = np.full(int(offsets[-1]) + 1, -1, np.int64)
    number[offsets] = np.arange(n)
    back = offsets[:, None] - (1 << np.arange(SEQUENCE.bit_length()))
    found = np.where(back >= 0, number[np.maximum(back, 0)], -1)
    exact = found[found >= 0].tolist()
    until = np.cumsum((found >= 0).sum(axis=1)).tolist()
    at = places.tolist()
    total, came = [0.0] * n, [0] * n
    # The queue: predecessors by place, with rising cost + place; those before head are too far.
    keys, who, head, seen = [float(at[0])], [0], 0, 0
    steps = zip(at, costs.tolist(), first, until)
    next(steps)
    for j, (place, cost, least, stop) in enumerate(steps, 1):
        while who[head] < least:
            head += 1
        best, i = keys[head] + SEQUENCE - place, who[head]
        if seen != stop:
            for k in exact[seen:stop]:
                if total[k] <= best:
                    best, i = total[k], k
            seen = stop
        best += cost
        total[j], came[j] = best, i
        best += place
        while len(keys) > head and keys[-1] >= best:
            del keys[-1], who[-1]
        keys.append(best)
        who.append(j)
    chain = [n - 1]
    while chain[-1]:
        chain.append(came[chain[-1]])
    return [at[i] for i in reversed(chain)]


def offered_places(doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places to cut at, from 0 to the end of the last document, and their costs."""
    ends = np.unique(np.concatenate(([0], doc_ends)))
    inner = np.setdiff1d(sentence_ends, ends)
    places = np.concatenate((ends, inner))
    costs = np.concatenate((np.zeros(len(ends)), np.full(len(inner), SENTENCE_CUT)))
    order = np.argsort(places, kind="stable")
    places, costs = places[order], costs[order]
    wide = np.flatnonzero(np.diff(places) > SEQUENCE)
    if len(wide):
        forced = np.concatenate([np.arange(places[k] + FORCED_STEP, places[k + 1], FORCED_STEP) for k in wide])
        places = np.concatenate((places, forced))
        costs = np.concatenate((costs, np.full(len(forced), FORCED_CUT)))
        order = np.argsort(places, kind="stable")
        places, costs = places[order], costs[order]
    return places, costs


def powers_of_two(length: int) -> list[int]:
    """The parts of a window's length that need no padding, or the length itself."""
    parts = [1 << k for k in reversed(range(length.bit_length())) if length >> k & 1]
    return parts if (len(parts) - 1) * FORCED_CUT < padding(length) else [length]


class Stream:
    """The part of a partition's stream that is not yet given out."""

    def __init__(self, first_sequence: int) -> None:
        self.sequence = first_sequence
        self.docs: list[tuple[int | None, int, int]] = []  # id, tokens, tokens already given out
        self.ids: list[bytes] = []
        self.sentences: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes, sentence_ends: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids) // 4, 0))
        self.ids.append(ids)
        self.sentences.append(sentence_ends + self.size)
        self.size += len(ids) // 4

    def take(self, last: bool) -> pa.RecordBatch:
        """Plan what is held and give out its windows, all but the unfinished one."""
        data = memoryview(b"".join(self.ids))
        lengths = np.array([n - done for _, n, done in self.docs], np.int64)
        doc_ends = np.cumsum(lengths)
        cuts = best_cuts(*offered_places(doc_ends, np.concatenate(self.sentences)))
        if last:
            parts = powers_of_two(cuts[-1] - cuts[-2])
            cuts = cuts[:-2] + np.cumsum([cuts[-2], *parts]).tolist()
        else:
            cuts = cuts[:-1]
        until = cuts[-1]
        borders = np.unique(np.concatenate((cuts, doc_ends[doc_ends < until])))
        starts, ends = borders[:-1], borders[1:]
        doc = np.searchsorted(doc_ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right") - 1
        doc_starts = doc_ends - lengths
        done = np.array([d for _, _, d in self.docs], np.int64)
        cut_places = np.array(cuts, np.int64)
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([self.docs[k][0] for k in doc.tolist()], pa.int64()),
                pa.array(starts - doc_starts[doc] + done[doc], pa.int64()),
                pa.array(ends - starts, pa.int64()),
                pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
                pa.array([self.docs[k][1] for k in doc.tolist()], pa.int64()),
                pa.array(self.sequence + window, pa.int64()),
                pa.array(starts - cut_places[window], pa.int64()),
                pa.array(np.diff(cut_places)[window], pa.int32()),
            ],
            _NAMES,
        )
        self.sequence += len(cuts) - 1
        k = int(np.searchsorted(doc_ends, until, side="right"))
        kept = [(i, n, d + max(0, until - int(doc_starts[k + p]))) for p, (i, n, d) in enumerate(self.docs[k:])]
        sentences = np.concatenate(self.sentences)
        self.ids, self.docs = [bytes(data[4 * until :])], kept
        self.sentences = [sentences[sentences > until] - until]
        self.size -= until
        return batch


def ends_sentence(word: str) -> bool:
    return FULL_STOP.search(word) is not None


def _sentence_ends(words: list[str], kept: list[bytes]) -> np.ndarray:
    """Numbers of tokens before the places after a full stop, exclamation or question mark.

    For one text cut into words; ``pack`` takes the same places from the table of words.
    """
    ends = set(filter(ends_sentence, set(words)))
    if not ends:
        return np.zeros(0, np.int64)
    last = np.fromiter(map(ends.__contains__, words), np.bool_, len(words))
    return (np.cumsum(np.fromiter(map(len, kept), np.int64, len(kept))) // 4)[last]


def pack(documents: DataFrame, path: str) -> DataFrame:
    """One row per piece of a document, with the sequence and the offset it stands at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bpe.word_table(path, ends_sentence)
        stream = Stream(TaskContext.get().partitionId() << 32)
        end = np.array([SEPARATOR], "<u4").tobytes()
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for a, b in ranges(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
                ids, borders, ends = known.encode(texts.slice(a, b - a))
                inside = np.searchsorted(ends, borders, side="right")
                for k, doc_id in enumerate(batch.column("doc_id").slice(a, b - a).to_pylist()):
                    sentences = ends[inside[k] : inside[k + 1]] - borders[k]
                    stream.add(doc_id, ids[borders[k] : borders[k + 1]].tobytes() + end, sentences)
                    if stream.size >= BLOCK:
                        yield stream.take(last=False)
        if stream.size:
            yield stream.take(last=True)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, PIECES)
