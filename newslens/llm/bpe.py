"""Byte-pair encoding by proposing tokens greedily and verifying adjacent pairs.

A text is cut into words as the vocabulary's own pre-tokenizer does. Each distinct word of
a batch is cut into the longest tokens from the left. That is the true encoding if, for
each two neighbours, no merge across their border could have come before the merges that
built them; this is checked for all distinct pairs at once with arrays of the merge
table. Only words with a failing pair are merged pair by pair.

Words are encoded once per batch and kept in a bounded cache, so the work follows the
number of distinct words. A ``WordTable`` does the same for whole slices of texts with
arrays, and takes the ids of new words from the library's model. Results equal those of the
``tokenizers`` library for the same file with ``add_special_tokens=False``.

Defined cases: a null text is an empty one and has no tokens; each input row yields one
row, also for null or repeated ids; the file's special tokens standing in a text are one
token each unless ``specials`` is false; an empty table gives no rows; columns other than
id and text are not read. Whole texts are encoded; a single word of any length takes time
n log n.
"""

from __future__ import annotations

import heapq
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import slices, strings

#: Words kept in a worker's cache; when it is full only those of the batch at hand stay.
CACHED_WORDS = 400_000
#: Letters up to which a failing word is merged by looking at all its pairs each time.
SHORT_WORD = 40
#: Ids of the words in a worker's table, beyond which it forgets some.
CACHED_IDS = 4_000_000
END_OF_WORD = "</w>"

# The cutting rule of the vocabulary file, for the characters up to U+017F.
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼-¾"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
#: The same rule for lower-case text, without runs of letters: what else stands between blanks.
_BETWEEN_LETTERS = f"'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+"
#: A character outside the plain ones, for which the library's own normaliser is asked.
_UNUSUAL = re.compile("[^\t\n\r -~¡-įı-ſ]")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, then U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


BYTE_LETTER = _byte_letters()
LETTER_BYTE = {letter: byte for byte, letter in enumerate(BYTE_LETTER)}
_NEVER = int(np.iinfo(np.int64).max)


class Encoder:
    """The tables of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.path = path
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.names: list[str] = [""] * size
        for name, number in [*self.vocab.items(), *self.special.items()]:
            self.names[number] = name
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in enumerate(merges)}
        self.made = {(self.vocab[a], self.vocab[b]): self.vocab[a + b] for a, b in merges}
        # How each token is built: its two halves and when. Base letters are there from -1 on.
        self.born = np.full(size, -1, np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        for (a, b), r in self.rank.items():
            token = self.made[a, b]
            if self.born[token] < 0:
                self.born[token], self.left[token], self.right[token] = r, a, b
        keys = np.array([a * size + b for a, b in self.rank] or [-1], np.int64)
        order = np.argsort(keys)
        self.size, self.keys = size, keys[order]
        self.key_rank = np.array([*self.rank.values()] or [0], np.int64)[order]
        self._special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        # Tokens that their own letters do not merge into are never proposed.
        tokens = np.flatnonzero(self.born >= 0)
        whole = self.compatible(self.left[tokens], self.right[tokens], self.born[tokens])
        self.unreachable = {self.names[t] for t in tokens[~whole]}
        for t in tokens:  # in order of birth if the file is in order; parts come before wholes
            if self.names[self.left[t]] in self.unreachable or self.names[self.right[t]] in self.unreachable:
                self.unreachable.add(self.names[t])
        # Tokens inside a word and at its end, and how long those with a given start can be.
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        self.reach: dict[str, int] = {}
        for name, number in self.vocab.items():
            if name in self.unreachable:
                continue
            if name.endswith(END_OF_WORD) and name != END_OF_WORD:
                self.final[name.removesuffix(END_OF_WORD)] = number
            else:
                self.inner[name] = number
                for n in range(1, min(len(name), 3) + 1):
                    self.reach[name[:n]] = max(self.reach.get(name[:n], 0), len(name))
        self.longest_final = max(map(len, self.final), default=0)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """For each pair: does no merge across the border come before those inside a and b?

        Looks back in time along the right edge of ``a`` and the left edge of ``b``: of the
        two pieces that touch, the later built one is taken apart. Two pieces exist together
        until one is built into something larger; a merge of the two before that, or at the
        same time as the one to its right, would have been made. ``until`` leaves out
        merges from that time on.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_used = np.full(len(x), _NEVER) if until is None else until.astype(np.int64)
        y_used = np.full(len(x), _NEVER) if until is None else until.astype(np.int64) - 1
        good = np.ones(len(x), bool)
        todo = np.arange(len(x))
        while len(todo):
            key = x[todo] * self.size + y[todo]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[place] == key, self.key_rank[place], _NEVER)
            bad = (rank < x_used[todo]) & (rank <= y_used[todo]) & (rank < _NEVER)
            good[todo[bad]] = False
            todo = todo[~bad]
            x_born, y_born = self.born[x[todo]], self.born[y[todo]]
            more = (x_born >= 0) | (y_born >= 0)
            todo, x_born, y_born = todo[more], x_born[more], y_born[more]
            first = x_born > y_born
            i, j = todo[first], todo[~first]
            x_used[i], x[i] = x_born[first], self.right[x[i]]
            y_used[j], y[j] = y_born[~first], self.left[y[j]]
        return good

    def words(self, text: str, specials: bool = True) -> list[str]:
        """The words of a text; a special token is a word of its own."""
        if specials and self._special.search(text):
            out, at = [], 0
            for match in self._special.finditer(text):
                out += self.words(text[at : match.start()], False)
                out.append(match.group())
                at = match.end()
            return out + self.words(text[at:], False)
        if _UNUSUAL.search(text):
            return self._library_words(text)
        return _WORD.findall(text.lower())

    def _library_words(self, text: str) -> list[str]:
        tokenizer = _library(self.path)
        normal = tokenizer.normalizer.normalize_str(text)
        pieces = tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(LETTER_BYTE[c] for c in piece).decode("utf-8", "surrogateescape") for piece, _ in pieces]

    def _propose(self, letters: str) -> list[int]:
        """The longest token from the left, again and again."""
        inner, final, reach, n = self.inner, self.final, self.reach, len(letters)
        out, at = [], 0
        while at < n:
            if n - at <= self.longest_final and (token := final.get(letters[at:])) is not None:
                out.append(token)
                break
            longest = reach.get(letters[at : at + 3]) or reach.get(letters[at : at + 2]) or 1
            for end in range(min(n - 1, at + longest), at, -1):
                if (token := inner.get(letters[at:end])) is not None:
                    out.append(token)
                    at = end
                    break
            else:
                return []
        return out

    def _merge(self, letters: str) -> list[int]:
        """Exact merging, the earliest merge first and the leftmost of equals."""
        vocab = self.vocab
        tokens = [vocab.get(c) for c in letters[:-1]] + [vocab.get(letters[-1] + END_OF_WORD)]
        tokens = [t for t in tokens if t is not None]
        n = len(tokens)
        if n <= SHORT_WORD:
            get = self.rank.get
            ranks = [get(pair, _NEVER) for pair in zip(tokens, tokens[1:])]
            while ranks and (least := min(ranks)) < _NEVER:
                i = ranks.index(least)
                token = self.made[tokens[i], tokens[i + 1]]
                tokens[i : i + 2] = [token]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((tokens[i - 1], token), _NEVER)
                if i < len(ranks):
                    ranks[i] = get((token, tokens[i + 1]), _NEVER)
            return tokens
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, tokens[i], tokens[i + 1]) for i in range(n - 1) if (r := self.rank.get((tokens[i], tokens[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= n or tokens[j] != b:
                continue
            tokens[i], tokens[j] = self.made[a, b], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                pair = tokens[i], tokens[after[i]]
                if (r := self.rank.get(pair)) is not None:
                    heapq.heappush(heap, (r, i, *pair))
            if (k := before[i]) >= 0:
                pair = tokens[k], tokens[i]
                if (r := self.rank.get(pair)) is not None:
                    heapq.heappush(heap, (r, k, *pair))
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each of some distinct words."""
        out: list[list[int]] = []
        letters: list[str] = []
        for word in words:
            if (number := self.special.get(word)) is not None:
                letters.append("")
                out.append([number])
                continue
            if not (word.isascii() and word.isprintable()):
                word = "".join([BYTE_LETTER[b] for b in word.encode("utf-8", "surrogateescape")])
            letters.append(word)
            out.append(self._propose(word))
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter((t for ids in out for t in ids), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(out)), sizes)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing = set(owner[inner[~good[back]]].tolist()) | set(np.flatnonzero(sizes == 0).tolist())
        for k in failing:
            out[k] = self._merge(letters[k])
        return out


def library_encode(known: Encoder, words: list[str]) -> list[list[int]]:
    """The same by the model of the library itself, which is given words as it would cut them."""
    tokenize, special = _library(known.path).model.tokenize, known.special
    out = []
    for word in words:
        if word in special:
            out.append([special[word]])
            continue
        if not (word.isascii() and word.isprintable()):
            word = "".join([BYTE_LETTER[b] for b in word.encode("utf-8", "surrogateescape")])
        out.append([token.id for token in tokenize(word)])
    return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=4)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordCache:
    """What is kept of each word: ``keep`` makes it from the encoder and the word's ids."""

    def __init__(self, path: str, keep: Callable, specials: bool, encode: Callable) -> None:
        self.encoder, self.keep, self.specials, self.encode = encoder(path), keep, specials, encode
        self.kept: dict[str, object] = {}

    def documents(self, texts: list[str]) -> Iterator[tuple[list[str], list]]:
        """Per text its words and what is kept of each."""
        for a, b in slices(texts):
            words = [self.encoder.words(t, self.specials) for t in texts[a:b]]
            own = set().union(*words)
            new = list(own - self.kept.keys())
            if len(self.kept) + len(new) > CACHED_WORDS:
                self.kept = {w: self.kept[w] for w in own if w in self.kept}
            self.kept.update(zip(new, (self.keep(self.encoder, ids) for ids in self.encode(self.encoder, new))))
            kept = self.kept
            for text in words:
                yield text, [kept[w] for w in text]


class WordTable:
    """Words and their ids as arrays: whole slices of texts are cut, looked up and encoded at once.

    Only words not met before become Python strings; the library's model encodes them.
    ``marks`` says of a word whether its ends are wanted. Special tokens must hold no blank.
    """

    def __init__(self, path: str, marks: Callable[[str], bool]) -> None:
        self.encoder, self.marks = encoder(path), marks
        self.words = pa.array([], pa.string())
        self.ids = np.zeros(0, "<u4")
        self.starts, self.sizes, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.marked = np.zeros(0, np.bool_)

    def cut(self, texts: pa.Array) -> pa.Array:
        """The words of each text, and perhaps empty ones, which have no ids."""
        odd = pc.match_substring_regex(texts, _UNUSUAL.pattern)
        if self.encoder.special:
            names = "|".join(map(re.escape, self.encoder.special))
            odd = pc.or_(odd, pc.match_substring_regex(texts, names, ignore_case=True))
        plain = pc.replace_substring_regex(pc.utf8_lower(texts), _BETWEEN_LETTERS, r" \0 ")
        if pc.any(odd).as_py():
            words = [" ".join(self.encoder.words(text)) for text in texts.filter(odd).to_pylist()]
            plain = pc.replace_with_mask(plain, odd, pa.array(words, pa.string()))
        return pc.ascii_split_whitespace(plain)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, where each text begins and the last ends, and the ends of marked words."""
        if len(self.words) > CACHED_WORDS or len(self.ids) > CACHED_IDS:
            self._forget()
        cut = self.cut(texts.cast(pa.string()))
        code = self._codes(cut.flatten())
        ends = np.cumsum(self.sizes[code])
        borders = np.concatenate(([0], ends))[cut.offsets.to_numpy()]
        return self._gather(code), borders, ends[self.marked[code]]

    def _gather(self, code: np.ndarray) -> np.ndarray:
        sizes = self.sizes[code]
        shift = self.starts[code] - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(sizes.sum())]

    def _codes(self, words: pa.Array) -> np.ndarray:
        """The place of each word in the table, after new ones were added."""
        found = pc.index_in(words, value_set=self.words)
        code = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if found.null_count:
            new = words.filter(pc.is_null(found)).dictionary_encode()
            code[code < 0] = new.indices.to_numpy() + np.int64(len(self.words))
            self._learn(new.dictionary)
        self.used += np.bincount(code, minlength=len(self.words))
        return code

    def _learn(self, words: pa.Array) -> None:
        texts = words.to_numpy(zero_copy_only=False).tolist()
        ids = library_encode(self.encoder, texts)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum()))))
        self.marked = np.concatenate((self.marked, np.fromiter(map(self.marks, texts), np.bool_, len(texts))))
        self.used = np.concatenate((self.used, np.zeros(len(texts), np.int64)))
        self.words = pa.concat_arrays([self.words, words])

    def _forget(self) -> None:
        """The half of the words that was used most stays; older uses count for less."""
        half = len(self.words) // 2
        keep = np.sort(np.argpartition(self.used, len(self.used) - half)[len(self.used) - half :])
        self.ids = self._gather(keep)
        self.sizes, self.marked, self.used = self.sizes[keep], self.marked[keep], self.used[keep] // 2
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = self.words.take(pa.array(keep))


@lru_cache(maxsize=1)
def word_table(path: str, marks: Callable[[str], bool]) -> WordTable:
    """The worker's table for a file; it outlives a task."""
    return WordTable(path, marks)


_CACHES: dict[tuple, WordCache] = {}


def cache(path: str, keep: Callable, specials: bool = True, encode: Callable = Encoder.encode_words) -> WordCache:
    """The worker's cache for a file and a kind of value; it outlives a task."""
    key = (path, keep, specials, encode)
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = WordCache(path, keep, specials, encode)
    return _CACHES[key]


def id_bytes(_: Encoder, ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def id_and_token_text(known: Encoder, ids: list[int]) -> tuple[str, str]:
    return " ".join(map(str, ids)), " ".join([known.names[i] for i in ids])


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the tokens of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cache(path, id_bytes)
        for batch in batches:
            ids = [np.frombuffer(b"".join(kept), "<u4").astype(np.int32) for _, kept in known.documents(strings(batch, "text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return _texts(documents).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the names of the tokens, with a blank between two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = encoder(path).names
        for batch in batches:
            texts = [" ".join([names[i] for i in ids or []]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string"
    )


def digests(documents: DataFrame, path: str) -> DataFrame:
    """Encoding and decoding in one pass, without moving ids: their number and two digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cache(path, id_and_token_text)
        for batch in batches:
            sizes, ids_digests, text_digests = [], [], []
            for _, kept in known.documents(strings(batch, "text")):
                ids = " ".join([k[0] for k in kept])
                sizes.append(ids.count(" ") + 1 if ids else 0)
                ids_digests.append(hashlib.sha256(ids.encode()).hexdigest())
                text_digests.append(hashlib.sha256(" ".join([k[1] for k in kept]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _texts(documents).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
