"""BPE, packing and token counts against the tokenizers library."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given as given_values
from hypothesis import settings
from hypothesis import strategies as st

from newslens.llm import bpe, packing, token_counts
from newslens.llm.queries import op5_packing, op8_token_counts, op9_bpe, vocabulary

from .conftest import FOLDER, texts_of


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def own_ids(text, encode=bpe.Encoder.encode_words):
    known = bpe.WordCache(vocabulary(), bpe.id_bytes, True, encode)
    return [np.frombuffer(b"".join(kept), "<u4").tolist() for _, kept in known.documents([text])][0]


@pytest.mark.parametrize(
    "text",
    ["", " ", "don't WE'RE 'S", "<|endoftext|>x<|startoftext|> <|endoftext", "İΣΑΣ ς", "á", "\x1c\x85\xa0x", "½²ª", "x" * 3000, "日本 123 ٣", "a\x00b"],
)
def test_ids_and_text_of_odd_texts(library, text):
    ids = ids_of(library, text)
    assert own_ids(text) == ids
    assert own_ids(text, bpe.library_encode) == ids
    names = bpe.encoder(vocabulary()).names
    assert " ".join(names[i] for i in ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given_values(st.text(max_size=60))
def test_any_text(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    assert own_ids(text) == ids_of(library, text)


def test_failing_words_need_merging():
    known = bpe.encoder(vocabulary())
    r = random.Random(5)
    words = ["".join(r.choice("thenigaosr") for _ in range(r.randrange(1, 60))) for _ in range(400)]
    merged = [known._merge(w) for w in words]
    assert known.encode_words(words) == merged
    proposed = [known._propose(w) for w in words]
    assert any(p != m for p, m in zip(proposed, merged)) and any(p == m for p, m in zip(proposed, merged))


def test_encode_and_decode(spark, odd, library):
    encoded = bpe.encode(odd, vocabulary())
    rows = encoded.collect()
    assert len(rows) == odd.count()
    texts = texts_of(odd)
    for row in rows:
        if row["doc_id"] is not None:
            assert row["ids"] == ids_of(library, texts[row["doc_id"]])
    decoded = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, vocabulary()).collect()}
    assert decoded[4] == library.decode(ids_of(library, "one"), skip_special_tokens=False)
    assert decoded[2] == ""


def test_op9(spark, given, library):
    texts = texts_of(given)
    rows = op9_bpe(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = ids_of(library, texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def check_packing(rows, ids):
    """``ids``: doc_id -> list of the ids of each row with that id."""
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault(r["doc_id"], []).append(r)
    total = wasted = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.SEQUENCE and at == own[0]["sequence_length"]
        total, wasted = total + at, wasted + packing.padding(at)
    assert pieces.keys() == ids.keys()
    for doc, own in pieces.items():
        assert sum(r["length"] for r in own) == sum(len(x) + 1 for x in ids[doc])
        if len(ids[doc]) == 1:
            (tokens,) = ids[doc]
            at = 0
            for r in sorted(own, key=lambda r: r["start"]):
                part = np.array((tokens + [1])[at : at + r["length"]], "<u4").tobytes()
                assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part), len(tokens) + 1)
                at += r["length"]
    return total, wasted


def test_op5(spark, given, library):
    rows = op5_packing(spark, FOLDER).collect()
    total, wasted = check_packing(rows, {i: [ids_of(library, t)] for i, t in texts_of(given).items()})
    assert wasted < 0.02 * total


def test_packing_odd_documents(spark, odd, empty, library):
    ids = {}
    for r in odd.select("doc_id", "text").collect():
        ids.setdefault(r["doc_id"], []).append(ids_of(library, r["text"]))
    check_packing(packing.pack(odd, vocabulary()).collect(), ids)
    assert packing.pack(empty, vocabulary()).count() == 0


def test_cuts_are_the_cheapest():
    r = random.Random(3)
    for _ in range(30):
        places = np.array(sorted({0, *r.sample(range(1, 9000), 40), *range(0, 9001, 1500)}))
        costs = np.array([r.choice([0.0, 4.0, 64.0]) for _ in places])
        best = {0: 0.0}
        for j in range(1, len(places)):
            near = [i for i in range(j) if places[j] - places[i] <= packing.SEQUENCE]
            best[j] = costs[j] + min(best[i] + packing.padding(int(places[j] - places[i])) for i in near)
        cuts = packing.best_cuts(places, costs)
        price = sum(packing.padding(b - a) for a, b in zip(cuts, cuts[1:]))
        price += sum(costs[np.searchsorted(places, c)] for c in cuts[1:])
        assert price == pytest.approx(best[len(places) - 1])


@pytest.mark.parametrize("mark", [".", "!", "?", "。", "।", "؟", "۔", "！", "።"])
def test_every_sentence_end_is_offered(mark):
    known = bpe.WordCache(vocabulary(), bpe.id_bytes, True, bpe.library_encode)
    ((words, kept),) = known.documents([f"go {mark} " * 30])
    places = packing._sentence_ends(words, kept).tolist()
    lengths = np.cumsum([len(k) // 4 for k in kept]).tolist()
    assert places == [n for w, n in zip(words, lengths) if mark in w] and len(places) == 30


def test_a_very_long_word_takes_time_in_proportion():
    """A blob without a blank, of many times the letters of any token."""
    known = bpe.encoder(vocabulary())
    r = random.Random(5)
    blob = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    seconds = []
    for size in (100_000, 400_000):
        begin = time.perf_counter()
        ids = known.encode_words([blob[:size]])
        seconds.append(time.perf_counter() - begin)
    assert seconds[1] < 10 * seconds[0] + 1, seconds
    assert ids == bpe.library_encode(known, [blob])


def test_long_stretch_without_sentences():
    places, costs = packing.offered_places(np.array([10_000]), np.zeros(0, np.int64))
    assert np.diff(places).max() <= packing.SEQUENCE and costs.max() == packing.FORCED_CUT


def test_op8(spark, given, library):
    counted = {r["doc_id"]: r["n_tokens"] for r in op8_token_counts(spark, FOLDER).collect()}
    known = library
    known.encode_special_tokens = True
    assert counted == {i: len(ids_of(known, t)) for i, t in texts_of(given).items()}
    known.encode_special_tokens = False


def blocks(spark, files):
    rows = []
    for name, (ids, sizes) in files.items():
        at = 0
        for number, size in enumerate(sizes):
            rows.append((name, number * 2, bytearray(np.array(ids[at : at + size], "<u4").tobytes())))
            at += size
    return spark.createDataFrame(rows, "file string, block int, tokens binary")


def test_separators_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 4)
    r = random.Random(11)
    files, wanted = {}, {}
    for name in "abcde":
        ids = [r.choice([9, 9, 9, 9, 7, 8]) if name != "e" else 8 for _ in range(60)]
        if name == "b":
            ids[-1] = 7
        sizes = []
        while sum(sizes) < 60:
            sizes.append(min(r.randrange(0, 9), 60 - sum(sizes)))
        files[name] = ids, sizes
        start = 0
        docs = []
        for i, x in enumerate([*ids, None]):
            if x == 7 or (x is None and i > start):
                docs.append((start, i - start))
                start = i + 1
        wanted[name] = docs
    found = token_counts.separator_scan(blocks(spark, files), separator=7).collect()
    for name, docs in wanted.items():
        own = sorted((x["doc_index"], x["first_token"], x["n_tokens"]) for x in found if x["file"] == name)
        assert own == [(k, a, n) for k, (a, n) in enumerate(docs)]


def test_token_blocks_cover_blocks(spark, odd, empty, library, monkeypatch):
    blocks = token_counts.token_blocks(odd, vocabulary())
    found = token_counts.separator_scan(blocks, carry=["doc_ids"]).selectExpr("doc_ids[place] AS doc_id", "n_tokens").collect()
    assert len(found) == odd.count()
    lengths = {r["doc_id"]: r["n_tokens"] for r in found}
    assert lengths[2] == lengths[1] == 0 and lengths[4] == 1
    assert token_counts.separator_scan(token_counts.token_blocks(empty, vocabulary())).count() == 0


def test_flat_files_read_by_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 5)
    ids = [3, 3, 7, 7, 4, 4, 4, 4, 4, 4, 4, 4, 7, 5]
    (tmp_path / "shard.bin").write_bytes(np.array(ids, "<u4").tobytes())
    found = token_counts.separator_scan(token_counts.read_blocks(spark, str(tmp_path)), separator=7)
    assert sorted((r["first_token"], r["n_tokens"]) for r in found.collect()) == [(0, 2), (3, 0), (4, 8), (13, 1)]
