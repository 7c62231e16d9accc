"""Spelling variants against all pairs of words, and the words against the rule they come from."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np

from newslens.llm import spelling
from newslens.llm.queries import QUERIES

from .conftest import FOLDER, frame


def brute_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'null' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            total[low] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_variants(words):
    form, near = {}, {}
    for w in words:
        close = [v for v in words if abs(len(v) - len(w)) <= 1 and is_near(w, v)]
        near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, words[w], near[w], form[w], words[form[w]] if form[w] else None, root)
    return out


def made_words(seed, n):
    """Words of few letters, so that many are near, many are anagrams and counts are often equal."""
    r = random.Random(seed)
    out = {}
    while len(out) < n:
        out["".join(r.choice("abqrāé😀"[: r.choice((2, 3, 4, 7))]) for _ in range(r.randint(5, 6)))] = r.choice((3, 3, 4, 6, 7, 12, 24, 50, 100))
    return out


def rows_of(df):
    return {r["word"]: (r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def test_near():
    r = random.Random(4)
    for _ in range(3000):
        a, b = ("".join(r.choice("ab") for _ in range(r.randint(1, 6))) for _ in range(2))
        assert spelling.near(a, b) == is_near(a, b), (a, b)
    words = ["".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(60)] + ["x" * 70, "x" * 71, "x" * 69 + "y"]
    words = list(dict.fromkeys(words))
    trie = spelling.Trie(words, [1] * len(words), 0)
    found = {frozenset((trie.words[a], trie.words[b])) for i, j in spelling.walk(trie, trie, 1, 1) for a, b in zip(i, j)}
    pairs = [frozenset((trie.words[a], trie.words[b])) for i, j in spelling.walk(trie, trie, 1, 1) for a, b in zip(i, j)]
    assert len(pairs) == len(found)
    assert found == {frozenset((a, b)) for a in words for b in words if is_near(a, b)}


def test_walk_with_small_pieces(monkeypatch):
    for name, value in (("SMALL", 1), ("STATES", 7), ("PAIRS", 5)):
        monkeypatch.setattr(spelling, name, value)
    words = list(made_words(9, 150))
    trie = spelling.Trie(words, [1] * len(words), 0)
    pairs = [frozenset((trie.words[a], trie.words[b])) for i, j in spelling.walk(trie, trie, 1, 1) for a, b in zip(i, j)]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in words for b in words if is_near(a, b)}


def test_variants_in_one_cell_many_cells_and_full_leaves(spark):
    words = made_words(1, 400)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute_variants(words)
    assert sum(v[3] is not None for v in want.values()) > 40 and any(v[3] and v[3] != v[5] for v in want.values())
    for limits in ({}, {"cell_words": 40, "cell_visitors": 10}, {"cell_words": 2, "cell_visitors": 3}):
        got = rows_of(spelling.variants(table, **limits))
        assert got == want, limits


def test_long_chain_of_forms(spark):
    words = {"a" * (5 + i): 3 * 2**i for i in range(12)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows_of(spelling.variants(table))
    assert got == brute_variants(words)
    assert got["aaaaa"][5] == "a" * 16


def test_very_long_words(spark):
    words = {"ab" * 50_000: 10, "ab" * 50_000 + "c": 3, "ab" * 20_000 + "x" + "ab" * 30_000: 4, "ab" * 49_999 + "ac": 40, "short": 5}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows_of(spelling.variants(table))
    assert got["ab" * 50_000][3] == "ab" * 49_999 + "ac" and got["ab" * 50_000][2] == 3
    assert got["short"][1:] == (5, 0, None, None, "short")


def test_words_of_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    rows += [(50 + i, "Straße ÉCOLE × école, straÃ\n" * 4 + "worlds-worldsĀworlds ") for i in range(300)]
    want = brute_words(rows)
    assert any("cole" in w for w in want)
    counts = {r["word"]: r["n"] for r in spelling.count_words(frame(spark, rows)).collect()}
    assert counts == want


def test_texts_in_pieces():
    text = "Worlds and worlds apart, aeiou × école " * 50
    whole = sum(spelling.runs_of(7, text), Counter())
    pieces = list(spelling.runs_of(7, text, 10))
    assert len(pieces) > 50 and sum(pieces, Counter()) == whole
    assert sum(whole.values()) == 350


def test_empty_table(spark, empty):
    assert spelling.spelling_variants(empty).count() == 0


def test_query(spark, given):
    rows = [(r["doc_id"], r["text"]) for r in given.select("doc_id", "text").collect()]
    got = rows_of(QUERIES["op12_spelling"](spark, FOLDER))
    words = brute_words(rows)
    # All pairs by their letters less one, which is quick enough for the whole table.
    keys = {}
    for w in words:
        for key in {(i, w[:i] + w[i + 1 :]) for i in range(len(w))} | {(-1, w)} | {(-1, w[:i] + w[i + 1 :]) for i in range(len(w))}:
            keys.setdefault(key, set()).add(w)
    close = {w: set() for w in words}
    for group in keys.values():
        for a in group:
            close[a] |= {b for b in group if is_near(a, b)}
    assert set(got) == set(words)
    for w in words:
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 2 * words[w] else None
        assert got[w][1:4] == (words[w], len(close[w]), form), w
        assert got[w][5] == (got[form][5] if form else w)
    assert np.mean([v[3] is not None for v in got.values()]) > 0
