"""The table of words that packing encodes with: the library's ids and every sentence end, in less time than word by word."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from newslens.llm import bpe, packing
from newslens.llm.queries import vocabulary

PARTS = [
    "don't", "WE'RE", "'S", "'tis", "''s", "it's'll!s", "12'3", "½²ª", "«x»", "Bar", "end.", "e.g.)", "...", "ÀÉ", "ß", "ŉ", "ſs'ſ",
    "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>y", "İΣΑΣ ς", "á", "\x1c\x85\xa0x", "日本。 123 ٣", "a\x00b", "\n\n", "\t", "\x0b\x0c", "–",
]


def odd_texts():
    r = random.Random(7)
    return ["", " ", "y" * 3000] + ["".join(r.choice(PARTS) + r.choice(["", " "]) for _ in range(r.randrange(30))) for _ in range(800)]


def word_by_word(texts):
    known = bpe.WordCache(vocabulary(), bpe.id_bytes, True, bpe.library_encode)
    return [(b"".join(kept), packing._sentence_ends(words, kept).tolist()) for words, kept in known.documents(texts)]


def by_table(known, texts):
    ids, borders, ends = known.encode(pa.array(texts, pa.string()))
    return [
        (ids[a:b].tobytes(), (ends[(ends > a) & (ends <= b)] - a).tolist()) for a, b in zip(borders.tolist(), borders[1:].tolist())
    ]


def test_ids_and_sentence_ends():
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(vocabulary()), odd_texts()
    found = by_table(bpe.WordTable(vocabulary(), packing.ends_sentence), texts)
    assert found == word_by_word(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids, _ in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("bounds", [(20, 4_000_000), (400_000, 50)])
def test_a_table_that_forgets_words_finds_the_same(monkeypatch, bounds):
    monkeypatch.setattr(bpe, "CACHED_WORDS", bounds[0])
    monkeypatch.setattr(bpe, "CACHED_IDS", bounds[1])
    known, texts = bpe.WordTable(vocabulary(), packing.ends_sentence), odd_texts()
    found, sizes = [], []
    for start in range(0, len(texts), 10):
        found += by_table(known, texts[start : start + 10])
        sizes.append(len(known.words))
    assert found == word_by_word(texts)
    assert max(sizes) < len({w for t in texts for w in known.encoder.words(t)})


def test_a_text_of_known_words_takes_less_time_than_word_by_word():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8))) for _ in range(2000)]
    texts = [" ".join(r.choice(words) + r.choice(["", "", ",", "."]) for _ in range(1000)) for _ in range(300)]
    known = bpe.WordTable(vocabulary(), packing.ends_sentence)
    known.encode(pa.array(texts[:5]))
    begin = time.process_time()
    known.encode(pa.array(texts))
    middle = time.process_time()
    word_by_word(texts)
    assert middle - begin < 0.6 * (time.process_time() - middle)
