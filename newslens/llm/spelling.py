"""Spelling variants: a trie over letter-group counts, searched with a surplus and a deficit.

Every word has a vector: how many of its letters fall into each of 16 groups. Arranged by
these counts, one group after the other, words form a trie. One inserted, deleted or replaced
letter changes the vector by at most one letter too many and one too few, so a depth-first
search that may spend a surplus of one and a deficit of one reaches every near word; words
at the leaves it reaches are verified letter by letter.

The trie is cut into cells, the subtrees under its first counts. A word lives in its own cell
and visits the cells before it that its budget reaches; two words therefore meet in one cell,
once. A cell with too many words is opened into its subtrees, as often as needed, so a hot
part of the trie is spread over tasks; visitors of one cell are dealt out in parts. Words
that are still too many when all counts are used up share all their letter counts; these few
leaves are joined by their words less one letter instead. In a task both sides are walked as
tries together, many states at a time, the deepest first. Near words are counted where they
are found: a pair is a row of a task, and a row per word is what moves.

A form has at least twice the count of its word, so chains of forms are short; their ends are
found by pointer doubling.

Null texts have no words; a null id counts as the text ``null``; repeated rows count each
time; very long texts are worked off in pieces, cut between words; an empty table gives an
empty result. Equal counts are decided by the order of code points. Other columns than id
and text are not read.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import code_points, materialise

#: One of so many runs, by hash, loses a letter.
THINNED = 97
#: Shortest word, least occurrences, and how often more a form occurs than its word.
MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2

#: Letter groups: the levels of the trie; a character belongs to the one of its code modulo 16.
GROUPS = 16
#: Levels by which a cell is opened at once.
OPENED = 2
#: Words that a cell may hold, visitors that one part of a cell may get.
CELL_WORDS, CELL_VISITORS = 10_000, 40_000
#: Cells whose counts are sent to all tasks.
BROADCAST_CELLS = 100_000
#: Pairs of subtrees with up to so many pairs of words are verified without a further step.
SMALL = 32
#: States and pairs of words that are worked on at once.
STATES, PAIRS = 200_000, 1_000_000
#: Words longer than this are compared one by one.
LONG = 64
#: Distinct words and characters that a counting task holds at once.
HELD_WORDS, PIECE = 300_000, 4_000_000

STATE = "cell string, role int, up int, down int, word string, n long"
HOME, VISITOR = 0, 1

# Characters of a run, A-Z in lower case; all others end it.
_KEPT = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]
RUN_BYTES = bytes((c + 32 if c < 0x5B else c) if c in _KEPT else 0x20 for c in range(256))


# Words of the documents


def _utf8(run: bytes) -> bytes:
    return run if run.isascii() else run.decode("latin-1").encode()


def runs_of(doc_id, text: str, piece: int = PIECE) -> Iterator[Counter]:
    """How often each run of a text occurs, in pieces, after some have lost a letter."""
    data = text.encode("latin-1", "replace").translate(RUN_BYTES)
    prefix = crc32(b"%s:" % ("null" if doc_id is None else str(doc_id)).encode())
    start = 0
    while start < len(data):
        end = data.find(b" ", start + piece)
        end = len(data) if end < 0 else end
        counts = Counter(data[start:end].split())
        for run in [r for r in counts if crc32(_utf8(r), prefix) % THINNED == 0]:
            at = crc32(_utf8(run), prefix) % len(run)
            less = run[:at] + run[at + 1 :]
            counts[less + b" "] += counts.pop(run)
        yield counts
        start = end


def count_words(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words with enough letters and occurrences."""

    def rows(counts: dict) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                if not value.is_valid:
                    continue
                for counts in runs_of(doc_id.as_py(), value.as_py()):
                    # A run that lost a letter carries a blank until here, so that it is not thinned again.
                    for word, n in counts.items():
                        word = word.rstrip()
                        if len(word) >= MIN_LETTERS:
                            total[word] = total.get(word, 0) + n
                    if len(total) > HELD_WORDS:
                        yield rows(total)
                        total = {}
        if total:
            yield rows(total)

    given = documents.select(key, F.col(text).cast("string").alias("text"))
    counted = given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


# Cells of the trie


def vectors(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter-group counts of the words, their characters in one array, and where each begins."""
    codes, ends = code_points(words)
    rows = np.repeat(np.arange(len(words)), np.diff(ends))
    places = rows * GROUPS + codes % GROUPS
    counts = np.bincount(places, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)
    return counts.astype(np.int32), codes, ends


def _moves() -> list[tuple[tuple[int, ...], int, int]]:
    """Changes of ``OPENED`` counts with at most one more and one less: (change, more, less)."""
    found = [()]
    for _ in range(OPENED):
        found = [m + (d,) for m in found for d in (-1, 0, 1)]
    return [(m, m.count(1), m.count(-1)) for m in found if m.count(1) <= 1 and m.count(-1) <= 1]


MOVES = _moves()


def opened(rows: DataFrame, level: int) -> DataFrame:
    """The rows in the subtrees of their cells after the counts from ``level`` on.

    A word at home stays at home in one subtree and visits those before it; a visitor goes on
    to whatever its budget still reaches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, roles, up, down, words, n = (c.to_pylist() for c in batch.columns)
            counts = vectors(words)[0][:, level : level + OPENED].tolist()
            out: list[tuple] = []
            for cell, role, more, less, word, times, here in zip(cells, roles, up, down, words, n, counts):
                for move, plus, minus in MOVES:
                    first = next((d for d in move if d), 0)
                    if role == HOME and first > 0 or plus > more or minus > less:
                        continue
                    there = [a + d for a, d in zip(here, move)]
                    if min(there) >= 0:
                        at = cell + "".join(f"{a}." for a in there)
                        out.append((at, role if not first else VISITOR, more - plus, less - minus, word, times))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()))],
                ["cell", "role", "up", "down", "word", "n"],
            ) if out else batch.slice(0, 0)

    return rows.mapInArrow(run, STATE)


# Search in a cell


class Trie:
    """Words under one cell, sorted by the counts from ``level`` on; nodes of each depth as arrays."""

    def __init__(self, words: list[str], n: list[int], level: int):
        counts, codes, ends = vectors(words)
        counts = counts[:, level:]
        order = np.lexsort(counts.T[::-1]) if counts.shape[1] else np.arange(len(words))
        counts = counts[order]
        self.codes, self.start, self.length = codes, ends[:-1][order], np.diff(ends)[order]
        self.words = [words[i] for i in order]
        self.text = pa.array(self.words, pa.string())
        self.n = np.array(n, np.int64)[order]
        self.depth = counts.shape[1]
        self.base = int(counts.max(initial=0)) + 3
        # Two characters at either end: one changed letter leaves one of the ends as it is.
        wide = self.codes.astype(np.uint64)
        last = self.start + self.length - 1
        second, before = np.minimum(self.start + 1, last), np.maximum(last - 1, self.start)
        self.head = wide[self.start] << np.uint64(32) | wide[second]
        self.tail = wide[before] << np.uint64(32) | wide[last]
        # Per depth: first row of each node, its key below its parent, its first child.
        self.rows = [np.array([0, len(words)])]
        self.keys: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.values = [np.zeros(1, np.int64)]
        self.children: list[np.ndarray] = []
        new = np.zeros(len(words), np.bool_)
        new[0] = True
        for d in range(self.depth):
            new[1:] |= counts[1:, d] != counts[:-1, d]
            rows = np.flatnonzero(new)
            parent = np.searchsorted(self.rows[d], rows, side="right") - 1
            value = counts[rows, d].astype(np.int64)
            self.values.append(value)
            self.keys.append(parent * self.base + value)
            self.children.append(np.searchsorted(parent, np.arange(len(self.rows[d]))))
            self.rows.append(np.append(rows, len(words)))

    def find(self, depth: int, parent: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of ``depth`` below the parents with the values, and which of them there are."""
        keys, wanted = self.keys[depth], parent * self.base + value
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, (keys[at] == wanted) & (value >= 0) & (value < self.base - 1)


def near(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced character lies between two texts."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = len(os.path.commonprefix([a, b]))
    return a[i + 1 :] == b[i + (len(a) == len(b)) :] if len(a) >= len(b) else a[i:] == b[i + 1 :]


def _shared(a: Trie, b: Trie, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """Length of the common beginning (or end) of pairs of words, at most ``most``."""
    out = np.zeros(len(i), np.int64)
    p = a.start[i] + (a.length[i] - 1 if back else 0)
    q = b.start[j] + (b.length[j] - 1 if back else 0)
    step, live = (-1 if back else 1), np.flatnonzero(most > 0)
    while len(live):
        k = out[live]
        live = live[a.codes[p[live] + step * k] == b.codes[q[live] + step * k]]
        out[live] += 1
        live = live[out[live] < most[live]]
    return out


def verified(a: Trie, b: Trie, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of words are near."""
    short = np.minimum(a.length[i], b.length[j])
    maybe = np.flatnonzero((a.head[i] == b.head[j]) | (a.tail[i] == b.tail[j]) | (short < 4))
    out = np.zeros(len(i), np.bool_)
    long = short[maybe] > LONG
    for k in maybe[long].tolist():
        out[k] = near(a.words[i[k]], b.words[j[k]])
    some = maybe[~long]
    i, j, short = i[some], j[some], short[some]
    longer = np.maximum(a.length[i], b.length[j])
    begin = _shared(a, b, i, j, short, False)
    different = (begin < longer) & (longer - short <= 1)
    end = _shared(a, b, i, j, np.where(different, short, 0), True)
    out[some] = different & (begin + end >= longer - 1)
    return out


def _pairs(a: Trie, b: Trie, depth: int, p: np.ndarray, q: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of words below pairs of nodes, in pieces; within one node each pair once."""
    first_a, size_a = a.rows[depth][p], a.rows[depth][p + 1] - a.rows[depth][p]
    first_b, size_b = b.rows[depth][q], b.rows[depth][q + 1] - b.rows[depth][q]
    # A row of words of one side at a time, so that even one large leaf is cut into pieces.
    row = np.repeat(np.arange(len(p)), size_a)
    i = np.arange(len(row)) - np.repeat(np.cumsum(size_a) - size_a, size_a) + first_a[row]
    many = size_b[row]
    starts = np.flatnonzero(np.diff(np.cumsum(many) // PAIRS, prepend=-1))
    for lo, hi in zip(starts, np.append(starts[1:], len(row))):
        width = many[lo:hi]
        left = np.repeat(i[lo:hi], width)
        right = np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first_b[row[lo:hi]], width)
        if same:
            once = np.repeat(p[row[lo:hi]] != q[row[lo:hi]], width) | (left < right)
            left, right = left[once], right[once]
        yield left, right


def walk(a: Trie, b: Trie, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of near words of two tries, or of one trie with itself, each pair once.

    A state is a node of either trie and what is left of surplus and deficit. States are kept
    on a stack in pieces; the piece on top goes one level down, so the stack stays small.
    """
    same = a is b
    zero = np.zeros(1, np.int64)
    stack = [(0, zero, zero, np.full(1, up), np.full(1, down))]
    while stack:
        depth, p, q, up_, down_ = stack.pop()
        size = (a.rows[depth][p + 1] - a.rows[depth][p]) * (b.rows[depth][q + 1] - b.rows[depth][q])
        done = np.ones(len(p), np.bool_) if depth == a.depth else size <= SMALL
        for i, j in _pairs(a, b, depth, p[done], q[done], same):
            good = verified(a, b, i, j)
            if good.any():
                yield i[good], j[good]
        p, q, up_, down_ = p[~done], q[~done], up_[~done], down_[~done]
        if not len(p):
            continue
        first = a.children[depth][p]
        many = a.children[depth][p + 1] - first
        row = np.repeat(np.arange(len(p)), many)
        child = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[row]
        value, parent, within = a.values[depth + 1][child], q[row], same & (p == q)[row]
        for change in (-1, 0, 1):
            at, there = b.find(depth + 1, parent, value + change)
            if change > 0:
                there &= (up_[row] > 0) & ~within
            elif change < 0:
                there &= down_[row] > 0
            hit = np.flatnonzero(there)
            for lo in range(0, len(hit), STATES):
                k = hit[lo : lo + STATES]
                stack.append((depth + 1, child[k], at[k], up_[row[k]] - (change > 0), down_[row[k]] - (change < 0)))


FOUND = "word string, other string, other_n long"


def _found(a: Trie, b: Trie, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Near words, each seen from both sides."""
    words = pa.concat_arrays([a.text.take(pa.array(i)), b.text.take(pa.array(j))])
    others = pa.concat_arrays([b.text.take(pa.array(j)), a.text.take(pa.array(i))])
    times = pa.array(np.concatenate((b.n[j], a.n[i])))
    return pa.RecordBatch.from_arrays([words, others, times], ["word", "other", "other_n"])


def search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of cells that arrive one after the other, words at home before visitors."""
    current, words, counts, home = None, [], [], None

    def settled() -> Iterator[pa.RecordBatch]:
        """The words at home among themselves, in the first part of a cell."""
        nonlocal home
        if home is None and words:
            home = Trie(words, counts, current[0].count("."))
            if current[1] == 0:
                for i, j in walk(home, home, 1, 1):
                    yield _found(home, home, i, j)

    for batch in batches:
        cells, parts, roles, up, down, word, n = (c.to_pylist() for c in batch.columns)
        state = list(zip(cells, parts, roles, up, down))
        lo = 0
        while lo < len(state):
            hi = lo + 1
            while hi < len(state) and state[hi] == state[lo]:
                hi += 1
            cell, part, role, more, less = state[lo]
            if (cell, part) != current:
                yield from settled()
                current, words, counts, home = (cell, part), [], [], None
            if role == HOME:
                words += word[lo:hi]
                counts += n[lo:hi]
            elif words:
                yield from settled()
                guests = Trie(word[lo:hi], n[lo:hi], cell.count("."))
                for i, j in walk(guests, home, more, less):
                    yield _found(guests, home, i, j)
            lo = hi
    yield from settled()


# All near words


def by_letter_less(rows: DataFrame) -> DataFrame:
    """Near words of cells with too many words of equal letter counts: an exact join.

    Two words differ by a replaced letter if they are equal without the letter at one same
    place, and by an inserted one if one is the other without some letter.
    """
    word = F.col("word")
    places = F.sequence(F.lit(1), F.length(word))
    less = F.transform(
        places,
        lambda i: F.struct(i.alias("at"), F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, F.length(word))).alias("text")),
    )
    replaced = F.transform(less, lambda s: F.struct(F.lit(0).alias("kind"), s["at"].alias("at"), s["text"].alias("text")))
    longer = F.transform(
        F.array_distinct(F.transform(less, lambda s: s["text"])),
        lambda t: F.struct(F.lit(1).alias("kind"), F.lit(0).alias("at"), t.alias("text")),
    )
    shorter = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("at"), word.alias("text")))
    keyed = rows.select("cell", "role", "word", "n", F.inline(F.concat(replaced, longer, shorter)))
    one = keyed.where(F.col("role") == HOME).drop("role", "n")
    two = keyed.select(
        "cell", (-F.col("kind")).alias("kind"), "at", "text", "role", F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    own = rows.where(F.col("role") == HOME).select("cell", "word", "n")
    pairs = one.join(two, ["cell", "kind", "at", "text"]).where("word <> other")
    back = pairs.where(F.col("role") == VISITOR).join(own, ["cell", "word"])
    return pairs.select("word", "other", "other_n").unionByName(
        back.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )


def near_words(
    words: DataFrame, cell_words: int = CELL_WORDS, cell_visitors: int = CELL_VISITORS
) -> DataFrame:
    """(word, other, other_n) for all near words, both ways; ``words`` is (word, n), each word once."""
    pending = words.select(
        F.lit("").alias("cell"), F.lit(HOME).alias("role"), F.lit(1).alias("up"), F.lit(1).alias("down"), "word", "n"
    )
    ready, leaves, size = [], None, 0
    for level in range(0, GROUPS, OPENED):
        pending = materialise(opened(pending, level))
        home = F.col("role") == HOME
        cells = materialise(
            pending.groupBy("cell")
            .agg(F.count_if(home).alias("homes"), F.count_if(~home).alias("visitors"))
            .where("homes > 0")
        )
        full = cells.where(F.col("homes") > cell_words)
        some = cells.agg(
            F.count(F.lit(1)).alias("cells"),
            F.count_if(F.col("homes") > cell_words).alias("full"),
            F.sum(F.when(F.col("homes") <= cell_words, F.col("homes") + F.col("visitors"))).alias("rows"),
        ).first()
        few = some["cells"] <= BROADCAST_CELLS
        parts = F.greatest(F.lit(1), F.ceil(F.col("visitors") / cell_visitors)).cast("int")
        fit = cells.where(F.col("homes") <= cell_words).select("cell", parts.alias("parts"))
        ready.append(pending.join(F.broadcast(fit) if few else fit, "cell"))
        size += some["rows"] or 0
        if not some["full"]:
            break
        pending = pending.join(F.broadcast(full.select("cell")) if few else full.select("cell"), "cell").select(*pending.columns)
        if level + OPENED == GROUPS:
            leaves = by_letter_less(pending)
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    # Words at home stand in all parts of their cell, a visitor in one.
    own = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    part = F.when(F.col("role") == HOME, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(own)
    dealt = every.select("cell", F.explode(part).alias("part"), "role", "up", "down", "word", "n")
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, size // (2 * cell_words) + 1)
    sorted_ = dealt.repartition(int(tasks), "cell", "part").sortWithinPartitions("cell", "part", "role", "up", "down")
    found = sorted_.mapInArrow(search_cells, FOUND)
    return found.unionByName(leaves) if leaves is not None else found


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) of each word end; there are no circles.

    Each round every word looks at what the word it points to points to, so a chain takes as
    many rounds as its length has binary digits. A form has as many followers as there are
    words one letter away from it, so no key is hot.
    """
    now = materialise(links.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = materialise(
            now.join(onward, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            )
        )
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, **limits: int) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n).

    The form of a word is its near word with the largest count, if that is at least
    ``ratio`` times its own; the root is where forms of forms end.
    """
    found = near_words(words, **limits).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"),
    )
    times = -F.col("best.less")
    chosen = times >= F.col("n") * ratio
    known = materialise(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(chosen, F.col("best.form")).alias("form"),
            F.when(chosen, times).alias("form_n"),
        )
    )
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of all documents with their forms and roots."""
    return variants(materialise(count_words(documents, key, text)))
