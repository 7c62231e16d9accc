"""N-gram join, suffix deduplication and fingerprints against brute force or SQL."""

import random
import re
import tracemalloc

import numpy as np
import pytest

import oracle
from newslens.llm import components, fingerprints, ngram_join, suffix_dedup
from newslens.llm.queries import op2_ngram_join, op4_suffix_dedup
from newslens.llm.words import run_hashes, word_hashes

from .conftest import FOLDER, frame, sentence, texts_of

WORD = re.compile(r"\w+")


def runs(text):
    words = WORD.findall((text or "").replace("İ", "i").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def brute_classes(rows):
    """Links and least ids of the classes, for a list of (doc_id, text)."""
    sets = [runs(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            both = len(x & y)
            if x == y or 5 * both >= 4 * (len(x) + len(y) - both) and both:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, least.get(root(k)), links[k]) for k, (i, _) in enumerate(rows)), key=repr)


def found_classes(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect()), key=repr)


def edited(text, seed, share):
    r = random.Random(seed)
    words = text.split()
    for k in range(len(words)):
        if r.random() < share:
            words[k] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


def test_op2_against_all_pairs(spark, given):
    rows = list(texts_of(given).items())
    assert found_classes(op2_ngram_join(spark, FOLDER)) == brute_classes(rows)


def test_group_of_near_copies_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_RUNS", 900)
    base = sentence(5, 120)
    rows = [(k, edited(base, k, 0.012)) for k in range(90)] + [(200 + k, sentence(100 + k, 40)) for k in range(30)]
    rows += [(300 + k, base) for k in range(5)]
    assert found_classes(ngram_join.near_duplicates(frame(spark, rows))) == brute_classes(rows)


def test_group_of_many_short_texts_over_blocks_of_nodes(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 20)
    monkeypatch.setattr(ngram_join, "STRIP", 100)
    base = sentence(6, 30).split()
    rows = [(k, " ".join(base[:29] + [f"no{k % 75}", "x" * (k % 2)])) for k in range(150)] + [(500, "a b")]
    assert found_classes(ngram_join.near_duplicates(frame(spark, rows))) == brute_classes(rows)
    blocks = []
    monkeypatch.setattr(ngram_join, "block_pairs", lambda d, members: blocks.extend(members.collect()) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ngram_join.near_duplicates(frame(spark, rows))
    assert len({r["block"] for r in blocks}) > 3


def test_memory_of_a_block_pair_of_short_texts():
    random_ = np.random.default_rng(3)
    common = random_.integers(0, 2**63, 22).astype(np.uint64)
    rows = [
        {"node": k, "copies": 1, "i": 0, "j": 1, "block": k % 2, "runs": np.r_[common, random_.integers(0, 2**63, 4).astype(np.uint64)].tobytes()}
        for k in range(4000)
    ]
    tracemalloc.start()
    found = ngram_join.compare(rows, 0.6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(k, 0, 2000) for k in range(4000)]
    assert peak < 150e6


def test_ngram_odd_documents(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert found_classes(ngram_join.near_duplicates(odd)) == brute_classes(rows)
    assert ngram_join.near_duplicates(empty).count() == 0


def test_keep_one_of_each_class(spark, odd, empty):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # Null, empty and blank texts are one class; the text without an id is one of its own.
    assert sorted(ids, key=str) == sorted([1, 4, 5, None, 6, 8, 10, -3], key=str)
    assert ngram_join.keep_one(empty).count() == 0


def test_letters_beyond_the_first_plane_are_words(spark):
    head = "notice of the day"
    rare = ["".join(chr(0x20000 + 40 * k + j) for j in range(6)) for k in range(8)]
    rows = [(k, f"{head} {' '.join(rare[k:] + rare[:k])} 𝐚𝐛{chr(0x1D41A + k)}") for k in range(6)]
    rows += [(10 + k, rare[k]) for k in range(3)] + [(20, rare[0])]
    assert found_classes(ngram_join.near_duplicates(frame(spark, rows))) == brute_classes(rows)
    assert sorted(r["doc_id"] for r in ngram_join.keep_one(frame(spark, rows)).collect()) == [*range(6), 10, 11, 12]


def test_texts_without_words_stay_apart(spark):
    rows = [(1, "😀"), (2, "😀 🎉"), (3, " 😀\n"), (4, "--- ***"), (5, ""), (6, None), (7, " \t"), (8, "!?")]
    assert sorted(r["doc_id"] for r in ngram_join.keep_one(frame(spark, rows)).collect()) == [1, 2, 4, 5, 8]
    links = {r["doc_id"]: r["n_links"] for r in ngram_join.near_duplicates(frame(spark, rows)).collect()}
    assert links == {1: 1, 2: 0, 3: 1, 4: 0, 5: 2, 6: 2, 7: 2, 8: 0}


def test_repeated_id_with_other_text_stays(spark):
    rows = [(1, sentence(1, 40)), (1, sentence(2, 40)), (2, sentence(2, 40)), (1, sentence(1, 40))]
    kept = sorted(r["text"] for r in ngram_join.keep_one(frame(spark, rows)).collect())
    assert kept == sorted([sentence(1, 40), sentence(2, 40)])


def test_prefix_reaches_recall():
    d = ngram_join.prefix_length()
    chance = lambda n: 1 - (1 - ngram_join.THRESHOLD**n) ** ngram_join.TREES
    assert chance(d) >= ngram_join.RECALL and (d == ngram_join.LONGEST or chance(d + 1) < ngram_join.RECALL)


def test_recall_of_candidates_at_the_threshold():
    masks, odds = ngram_join._hash_family(ngram_join.TREES * ngram_join.prefix_length())
    random_ = np.random.default_rng(4)
    met = 0
    for _ in range(200):
        values = random_.integers(0, 2**63, 900).astype(np.uint64)
        a, b = values[:800], values[np.r_[0:712, 800:888]]  # likeness 712 / 888 = 0.802
        keys = [ngram_join.path_keys(ngram_join.minhash(np.sort(x), masks, odds), ngram_join.TREES) for x in (a, b)]
        met += bool((keys[0] == keys[1]).any())
    assert met >= 196


def test_shared_counts():
    r = random.Random(2)
    sets = [np.array(sorted(r.sample(range(60), r.randrange(0, 40))), np.uint64) for _ in range(25)]
    got = ngram_join.shared_counts(sets)
    for a in range(25):
        for b in range(25):
            assert a == b or got[a, b] == len(set(sets[a].tolist()) & set(sets[b].tolist()))


def test_components(spark):
    r = random.Random(8)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(120)]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: root(k) for a, b in links for k in (a, b) if a != b} | {k: v for k, v in got.items() if k not in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Passages


def brute_spans(rows):
    held, spans = {}, {}
    for i, text in sorted(rows):
        words = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text or "")]
        for s in range(len(words) - 49):
            held.setdefault(tuple(w for w, _, _ in words[s : s + 50]), []).append((i, words[s][1], words[s + 49][2]))
    for places in held.values():
        if len(places) > 1:
            for k, (i, a, b) in enumerate(places):
                spans.setdefault((i, k == 0), []).append((a, b))
    out = []
    for (i, kept), own in spans.items():
        joined = []
        for a, b in sorted(own):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        out += [(i, a, b, kept) for a, b in joined]
    return sorted(out)


def found_spans(df):
    return sorted((r["doc_id"], r["start"], r["end"], r["kept"]) for r in df.collect())


def test_op4_against_all_passages(spark, given):
    assert found_spans(op4_suffix_dedup(spark, FOLDER)) == brute_spans(list(texts_of(given).items()))


def test_passages_of_51_words_are_found(spark):
    passage = sentence(70, 51)
    rows = [(k, f"{sentence(10 + k, 30 + 3 * k)} {passage} {sentence(40 + k, 25)}") for k in range(12)]
    rows += [(50, sentence(90, 49)), (51, sentence(90, 49) + " " + sentence(91, 40)), (60, passage + " " + passage), (61, "go " * 120)]
    want = brute_spans(rows)
    assert found_spans(suffix_dedup.repeated_passages(frame(spark, rows))) == want
    assert {i for i, *_ in want} == {*range(12), 60, 61}


def test_passages_with_letters_beyond_the_first_plane(spark):
    words = sentence(70, 60).split()
    mixed = lambda at: " ".join(f"{w} {chr(0x20000 + at + k)}" for k, w in enumerate(words))
    rare = " ".join(chr(0x20500 + k) for k in range(55))
    rows = [(1, mixed(0)), (2, mixed(100)), (3, rare + " one"), (4, "two " + rare)]
    want = brute_spans(rows)
    assert found_spans(suffix_dedup.repeated_passages(frame(spark, rows))) == want
    assert {i for i, *_ in want} == {3, 4}


def test_removal_keeps_the_first(spark, odd, empty):
    passage = sentence(70, 60)
    rows = [(1, f"Start. {passage} end"), (2, f"é {passage}, more"), (3, passage), (4, "plain"), (5, None)]
    out = suffix_dedup.remove_repeats(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert texts[1][0] == rows[0][1] and texts[4] == ("plain", 5) and texts[5] == (None, None)
    assert passage[:-1] not in texts[2][0] and texts[2][0].startswith("é ") and texts[2][0].endswith(", more")
    assert texts[3][0].strip(".") == "" and texts[3][1] == len(texts[3][0])
    assert suffix_dedup.remove_repeats(odd).count() == odd.count()
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert suffix_dedup.repeated_passages(empty).count() == 0


def test_repeated_rows_lose_all_copies_but_one(spark):
    """Rows that repeat id and text: one stays as it is, the others are cut from end to end."""
    t, u, v = sentence(71, 80), sentence(72, 90), sentence(73, 70)
    rows = [(1, t), (1, t), (2, u), (3, t), (3, t), (4, v), (4, v), (4, v), (5, f"x {u} y"), (5, f"x {u} y"), (None, u), (None, u)]
    left = [(r["doc_id"], r["text"].strip(" .")) for r in suffix_dedup.remove_repeats(frame(spark, rows).repartition(3)).collect()]
    assert len(left) == len(rows)
    for i, text, n in ((1, t, 1), (2, u, 1), (3, t, 0), (4, v, 1), (None, u, 0)):
        mine = [x for k, x in left if k == i]
        assert sorted(x for x in mine if x) == [text.strip(" .")] * n, i
    # One of the two rows of 5 keeps what is its own, the other is a copy of it.
    assert sorted(len(x) for k, x in left if k == 5)[0] == 0
    assert sorted((x for k, x in left if k == 5), key=len)[1].startswith("x")
    spans = {(r["doc_id"], r["kept"], r["first_doc_id"]) for r in suffix_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert {(1, True, 1), (1, False, 1), (2, True, 2), (3, False, 1), (4, True, 4), (4, False, 4), (5, False, 2)} <= spans


def test_many_rows_of_one_id_and_text(spark):
    t = sentence(74, 60)
    rows = [(1, t)] * 500 + [(2, sentence(75, 60))]
    left = [r["text"] for r in suffix_dedup.remove_repeats(frame(spark, rows).repartition(7)).collect()]
    assert len(left) == 501 and sum(x == t for x in left) == 1 and sum(len(x) > 50 for x in left) == 2


def test_spans_of_one_text_do_not_cut_another_under_its_id(spark):
    passage, other = sentence(70, 60), sentence(71, 60)
    clean = sentence(72, 200)
    rows = [
        (1, f"Start {passage} end"), (5, f"Here {passage} stands"), (5, clean), (5, f"{sentence(73, 20)} {other}"), (5, f"Now {other} ends"),
        (None, f"{sentence(74, 15)} {passage}"), (7, clean + " more"),
    ]
    left = [r["text"] for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()]
    # Texts that stand first are whole; every passage is left once.
    assert rows[0][1] in left and clean in left and " more" in left
    core = " ".join(passage.split()[:59])
    assert sum(core in t for t in left) == 1 and sum(" ".join(other.split()[:59]) in t for t in left) == 1
    assert "Here . stands" in left and len(left) == len(rows)
    assert (rows[3][1] in left) != (rows[4][1] in left)


def test_hashes_of_runs_do_not_depend_on_place():
    hashes, first, last, borders = word_hashes(["a bb ccc dd e", "zz a BB, ccc; dd e", ""])
    one, two = hashes[: borders[1]], hashes[borders[1] : borders[2]]
    assert (run_hashes(one, 5) == run_hashes(two, 5)[1:]).all() and borders[2] == borders[3]
    assert (first[1], last[1]) == (2, 4)


# Fingerprints


@pytest.fixture(scope="module")
def sql():
    return oracle.connect(FOLDER)


def test_op1_against_sql(spark, sql):
    assert oracle.compare(spark, sql, "op1_imatch", FOLDER) == ""


def test_fingerprints_of_odd_documents(spark, odd, empty):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == odd.count()
    texts = sorted(((r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    import hashlib

    want = []
    for k, (i, t) in enumerate(texts):
        half = len(t) // 2
        new = t[: len(t) - half] + texts[(k + 1) % len(texts)][1][:half]
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=repr) == sorted(want, key=repr)
    of = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert of[1] == of[2] and of[6] == of[7] and of[8] == of[9] and of[8] != of[6]
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    assert all(r["near_edited"] == 1 for r in rows if r["fingerprint"] == r["edited_fingerprint"])
    assert fingerprints.fingerprints(empty).count() == 0


def test_single_document_follows_itself(spark):
    (row,) = fingerprints.fingerprints(frame(spark, [(5, "abcdef")])).collect()
    assert row["near_next"] == 1.0 and row["n_chars"] == 6
