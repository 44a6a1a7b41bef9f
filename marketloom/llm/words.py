"""Words of a text as 64-bit hashes, a whole text at a time.

Words are runs of bytes other than space, tab, newline, vertical tab, form feed
and carriage return.  Hashes stand for words in joins; two different words of a
corpus of 10 ** 9 words share one with a chance of about 3 in 100."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_powers = np.multiply.accumulate(np.full(256, _BASE, dtype=np.uint64))


def _power_table(length: int) -> np.ndarray:
    global _powers
    if length > len(_powers):
        _powers = np.multiply.accumulate(np.full(2 * length, _BASE, dtype=np.uint64))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _A
    h = (h ^ (h >> np.uint64(27))) * _B
    return h ^ (h >> np.uint64(31))


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, and the starts and ends of the words."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[b]
    turns = np.diff(inside)
    return b, np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def word_hashes(data: bytes | None) -> np.ndarray:
    """One hash for each word, in order."""
    if not data:
        return np.zeros(0, dtype=np.uint64)
    b, starts, ends = word_spans(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    letters = _VALUES[b[~_SPACE[b]]]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = _power_table(int(lengths.max()))
    return mix(np.add.reduceat(letters * powers[place], first))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` words (none if there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(n, np.uint64(k))
    for i in range(k):
        h = h * _BASE + words[i : i + n]
    return mix(h)
