"""Hashes of words and of runs of words, for many texts at once.

A word is a run of letters, digits and underscores, in lower case. Hashes are 64 bits
wide, do not depend on the machine, and are made with arrays only.
"""

from __future__ import annotations

import numpy as np

from newslens.llm.common import code_points, mix64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _word_characters() -> np.ndarray:
    return np.frombuffer(bytes(chr(i).isalnum() or chr(i) == "_" for i in range(0x10000)), np.bool_)


#: For each character of the first plane: is it part of a word?
WORD_CHARACTER = _word_characters()
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < size:
        size = 1 << (size - 1).bit_length()
        _powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _BASE))), dtype=np.uint64)
        _inverses = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _INVERSE))), dtype=np.uint64)
    return _powers, _inverses


def lowered(text: str) -> str:
    """Lower case without a change of length, so that offsets hold in the text itself."""
    return text.replace("İ", "i").lower()


def in_words(codes: np.ndarray) -> np.ndarray:
    """For each character: is it part of a word? Those beyond the first plane are looked up one by one."""
    flags = WORD_CHARACTER[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        distinct, inverse = np.unique(codes[beyond], return_inverse=True)
        flags[beyond] = np.array([chr(c).isalnum() for c in distinct.tolist()], np.bool_)[inverse]
    return flags


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts: hash, first and last + 1 character; and where each text's words begin.

    Characters are counted from the start of the word's own text.
    """
    codes, ends = code_points([lowered(t) + " " for t in texts])
    if not len(codes):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(texts) + 1, np.int64)
    inside = in_words(codes)
    change = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    powers, inverses = _power_tables(len(codes))
    running = np.concatenate(([np.uint64(0)], np.cumsum((codes + np.uint32(1)) * powers[: len(codes)], dtype=np.uint64)))
    hashes = mix64((running[last] - running[first]) * inverses[first] + (last - first).astype(np.uint64))
    borders = np.searchsorted(first, ends)
    text_start = np.repeat(ends[:-1], np.diff(borders))
    return hashes, first - text_start, last - text_start, borders


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` words in a row, over all words as one sequence."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    # Powers of an odd number weigh the places; sums wrap, which is part of the hash.
    powers, inverses = _power_tables(len(hashes) + 1)
    running = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers[: len(hashes)], dtype=np.uint64)))
    return mix64((running[n:] - running[:size]) * inverses[:size] * _STEP)


def span_hashes(hashes: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of ``size`` words from ``first`` on, for spans of any lengths."""
    powers, inverses = _power_tables(len(hashes) + 1)
    running = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers[: len(hashes)], dtype=np.uint64)))
    return mix64((running[first + size] - running[first]) * inverses[first] * _STEP + size.astype(np.uint64))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of ``n`` words in a row of one text; a shorter text is one run."""
    if not len(words):
        return words
    return np.unique(run_hashes(words, min(n, len(words))))
