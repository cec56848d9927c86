"""Hashes of words and word shingles for many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

from dumpwise.llm.common import WORD_TABLE, mix64

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept for the next call."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def word_hashes(texts: list[bytes | None], table: bytes = WORD_TABLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and how many words each text has.

    ``table`` translates bytes first; words are what stands between spaces then.

    A word's hash is a difference of prefix sums of bytes weighted by powers of
    an odd base, brought to a common place by the inverse power, then mixed.
    """
    cut = [t.translate(table) if t else b"" for t in texts]
    data = np.frombuffer(b" " + b" ".join(cut) + b" ", np.uint8)
    ends_of_texts = np.cumsum([len(c) + 1 for c in cut])
    inside = data != 0x20
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = _power_tables(len(data))
    sums = np.cumsum(data * power[: len(data)], dtype=np.uint64)
    hashes = mix64((sums[ends - 1] - sums[starts - 1]) * inverse[starts] + (ends - starts).astype(np.uint64))
    upto = np.searchsorted(starts, ends_of_texts, side="right")
    return hashes, np.diff(np.concatenate([[0], upto])).astype(np.int64)


def shingles_of_texts(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes of all texts, where each text's begin, words per text).

    A text of fewer than ``size`` words has one shingle of all its words; one without words has none.
    """
    hashes, counts = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    per_text = np.where(counts == 0, 0, np.maximum(1, counts - size + 1))
    starts = np.concatenate([[0], np.cumsum(per_text)[:-1]]).astype(np.int64)
    total = int(per_text.sum())
    at = np.arange(total) + np.repeat(first - starts, per_text)
    length = np.repeat(np.minimum(counts, size), per_text)
    codes = length.astype(np.uint64)
    last = max(0, len(hashes) - 1)
    for k in range(size):
        step = mix64(codes * np.uint64(_BASE) + (hashes[np.minimum(at + k, last)] if len(hashes) else np.uint64(0)))
        codes = np.where(k < length, step, codes)
    return codes, starts, counts
