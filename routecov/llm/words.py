"""64-bit hashes of a text's words and word runs, for whole Arrow batches.

A word is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return; A-Z count as a-z.  Its hash is a
polynomial over per-byte random numbers modulo 2**64, read off a running sum,
so a batch of texts is hashed with a few passes of numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import SLAB_BYTES, slabs

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SLAB_BYTES, 1 << (n + 1).bit_length())
    if size not in _POWERS:
        up, down = np.full(size + 1, _BASE & (2**64 - 1), np.uint64), np.full(size + 1, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        if size > SLAB_BYTES:  # a rare oversized word: not kept
            return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        _POWERS[size] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS[size]


def _hash_slab(data: np.ndarray, starts_of_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of ``data``; rows never share a word."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(n)
    letter = ~_SPACE[data]
    edge = np.empty(n + 1, bool)
    edge[0], edge[n], edge[1:n] = True, True, letter[1:] != letter[:-1]
    edge[starts_of_rows] = True
    cuts = np.flatnonzero(edge)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    begin, end = cuts[:-1], cuts[1:]
    keep = letter[begin]
    begin, end = begin[keep], end[keep]
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slab of rows: the first row, all word hashes, and the rows' bounds in them."""
    for i, j in slabs(offsets):
        low, high = int(offsets[i]), int(offsets[j])
        if high - low <= SLAB_BYTES:
            hashes, begin = _hash_slab(data[low:high], offsets[i:j] - low)
            yield i, hashes, np.concatenate([np.searchsorted(begin, offsets[i:j] - low), [len(hashes)]])
            continue
        parts, at = [], low  # one long text, cut between words
        while at < high:
            end = min(high, at + SLAB_BYTES)
            if end < high:
                gaps = np.flatnonzero(_SPACE[data[at:end]])
                while not len(gaps) and end < high:
                    end = min(high, end + SLAB_BYTES)
                    gaps = np.flatnonzero(_SPACE[data[at:end]])
                end = at + int(gaps[-1]) + 1 if len(gaps) and end < high else end
            parts.append(_hash_slab(data[at:end], np.zeros(1, np.int64))[0])
            at = end
        hashes = np.concatenate(parts)
        yield i, hashes, np.array([0, len(hashes)])


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` successive words; a shorter text is one run."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total += words[i:n - k + 1 + i] * _PLACE[i % 64]
    return mix(total)
