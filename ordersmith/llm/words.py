"""Words and word shingles of whole Arrow batches, as 64-bit hashes.

A word is a run of ASCII letters, digits and bytes from 0x80 on, A-Z lowered:
the characters of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lowering. Texts of
any length, and words of any length, are handled in slices of a fixed size.
"""

from __future__ import annotations

import numpy as np

from ordersmith.llm.common import SLICE_BYTES, mix64

_U = np.uint64
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_VALUE = np.where(_IS_WORD, np.arange(256) + 1, 0).astype(np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_BASE = 0x100000001B3
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 64, 2 * len(_POWERS)), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p, dtype=np.uint64)
    return _POWERS


def word_spans(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, length) of every word in order, and n + 1 offsets of the documents' first words.

    A word's hash is a polynomial in its bytes, so a word that a slice cuts is
    carried on with the sum so far, however long it is.
    """
    first, last = int(offsets[0]), int(offsets[-1])
    bounds = offsets[(offsets > first) & (offsets < last)]
    hashes, starts, lengths = [], [], []
    cut = None                                    # (start, length, sum) of a word that reached the slice's end
    for a in range(first, last, SLICE_BYTES):
        b = min(a + SLICE_BYTES, last)
        part = values[a:b]
        word = _IS_WORD[part]
        edge = np.empty(len(part), bool)          # a word may begin here: text before it ends or is no word
        edge[0] = True
        np.logical_not(word[:-1], out=edge[1:])
        inner = bounds[np.searchsorted(bounds, a): np.searchsorted(bounds, b)] - a
        edge[inner] = True
        s = np.flatnonzero(word & edge)
        n, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if len(s):
            close = np.empty(len(part), bool)
            close[-1] = True
            np.logical_not(word[1:], out=close[:-1])
            close[inner[inner > 0] - 1] = True
            n = np.flatnonzero(word & close) + 1 - s
            reach = np.diff(np.append(s, len(part)))
            pos = np.arange(s[0], len(part), dtype=np.int64) - np.repeat(s, reach)
            np.minimum(pos, int(n.max()), out=pos)
            v = _VALUE[part[s[0]:]] * _powers(int(n.max()) + 1)[pos]
            h = np.add.reduceat(v, s - s[0])
            s = s + a
        if cut:
            begin, size, total = cut
            if len(s) and s[0] == a and not (len(inner) and inner[0] == 0):
                h[0] = total + pow(_BASE, size, 1 << 64) * int(h[0]) & 0xFFFFFFFFFFFFFFFF
                s[0], n[0] = begin, n[0] + size
            else:
                s, n, h = np.append(begin, s), np.append(size, n), np.append(_U(total), h)
            cut = None
        if word[-1] and b < last:
            cut = int(s[-1]), int(n[-1]), int(h[-1])
            s, n, h = s[:-1], n[:-1], h[:-1]
        hashes.append(mix64(h + n.astype(np.uint64) * _U(0xD6E8FEB86659FD93)))
        starts.append(s)
        lengths.append(n)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    start = np.concatenate(starts)
    return np.concatenate(hashes), start, np.concatenate(lengths), np.searchsorted(start, offsets).astype(np.int64)


def kgrams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (len - k + 1 values; none if there are fewer words)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc *= _U(0xA0761D6478BD642F)
        acc += words[j: j + n]
    return mix64(acc ^ _U(k))


def shingles(words: np.ndarray, word_off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every document's k-word shingles in order, and their counts by document.

    A document of fewer words, but not none, has one shingle: all its words.
    """
    n = np.diff(word_off)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    grams = kgrams(words, k)
    out = np.empty(int(counts.sum()), np.uint64)
    ends = np.cumsum(counts)
    long = n >= k
    if long.any():
        inside = np.zeros(len(grams) + 1, np.int64)      # +1 where a long document's grams begin, -1 where they end
        np.add.at(inside, word_off[:-1][long], 1)
        np.add.at(inside, word_off[:-1][long] + counts[long], -1)
        mask = np.cumsum(inside[:-1]) > 0
        slots = np.repeat(long, counts)
        out[slots] = grams[mask]
    for d in np.flatnonzero((n > 0) & ~long):
        out[ends[d] - 1] = kgrams(words[word_off[d]: word_off[d + 1]], int(n[d]))[0]
    return out, counts
