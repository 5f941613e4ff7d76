"""Words and word shingles of Arrow string columns as 64-bit hashes.

All work is done on the UTF-8 bytes of a whole block of texts at once: a word
is a run of bytes outside ``[\\x20\\x09-\\x0D]``, ``A-Z`` are lower-cased, and a
word's hash is a polynomial over its bytes read off one running sum.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidelog.llm.common import blocks_of, text_bytes

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII that is neither letter nor digit, for words without their punctuation.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEP = [np.uint64(x) for x in _RNG.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64's constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, BLOCK_BYTES + 1), np.uint64(base))
            steps[0] = np.uint64(1)
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Word hashes of a block of texts; text ``i`` has those from ``offsets[i]`` to ``offsets[i + 1]``.

    ``tail`` holds the last three bytes of each lower-cased word, for word-shape features.
    """

    hashes: np.ndarray
    offsets: np.ndarray
    tail: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def words_of(flat: np.ndarray, bounds: np.ndarray, separators: np.ndarray = _SPACE) -> Words:
    """The words of a block: runs of bytes that aren't ``separators`` (a mask of 256)."""
    n = len(flat)
    if not n:
        return Words(np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), np.zeros(0, np.int64))
    space = separators[flat]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[flat] * power[:n], dtype=np.uint64, out=total[1:])
    length = (ends - starts).astype(np.uint64)
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + length * np.uint64(0xD6E8FEB86659FD93))
    at = lambda back: np.where(ends - back >= starts, _LOWER[flat[np.maximum(ends - back, 0)]], 0)
    return Words(hashes, np.searchsorted(starts, bounds), at(1) | at(2) << 8 | at(3) << 16)


def word_blocks(column: pa.Array, most: int = BLOCK_BYTES, separators: np.ndarray = _SPACE):
    """``(first, last, Words)`` for consecutive blocks of rows of a string column."""
    flat, bounds = text_bytes(column)
    for first, last in blocks_of(bounds, most):
        own = bounds[first : last + 1]
        yield first, last, words_of(flat[own[0] : own[-1]], own - own[0], separators)


def shingles_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and their offsets by text.

    A text of fewer than ``k`` words has its whole sequence as its one shingle;
    a text without words has none. Repeats are kept.
    """
    h, n = words.hashes, words.counts
    m = len(h)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    if not m:
        return np.zeros(0, np.uint64), offsets
    total = np.zeros(m, np.uint64)
    for j in range(min(k, m)):
        total[: m - j] += h[j:] * _STEP[j]
    left = np.repeat(words.offsets[1:], n) - np.arange(m)
    chosen = left >= k
    for i in np.flatnonzero((n > 0) & (n < k)):
        a, size = words.offsets[i], n[i]
        value = np.uint64(size)
        for j in range(size):
            value = value + h[a + j : a + j + 1] * _STEP[j]
        total[a], chosen[a] = value[0], True
    return mix(total[chosen]), offsets
