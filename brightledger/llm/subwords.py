"""Hashed terms of whole texts as numpy arrays: words and character n-grams."""

from __future__ import annotations

import numpy as np

from . import words

_GRAM = [np.uint32(pow(0x9E3779B1, k + 1, 1 << 32)) for k in range(8)]


def slots(h: np.ndarray, bits: int) -> np.ndarray:
    """32-bit hashes to table slots."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h >> np.uint32(32 - bits)).astype(np.int32)


def gram(symbol: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A 32-bit hash of the n symbols from each place."""
    h = np.full(len(at), n, np.uint32)
    for k in range(n):
        h += symbol[at + k] * _GRAM[k]
    return h


def features(texts: list[bytes], bits: int, grams: tuple[int, ...]) -> tuple[list[np.ndarray], words.Words]:
    """Arrays (owner, slot) of each kind of feature: words, then character n-grams of each size.

    An n-gram lies within a word and one blank on either side.
    """
    split = words.split(texts)
    out = [(split.owner(), slots((split.hashes() >> np.uint64(32)).astype(np.uint32), bits))]
    data = split.data
    blank = np.take(words._SPACE, data)
    symbol = np.where(blank, np.uint8(0x20), data).astype(np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    for n in grams:
        size = len(data) - n + 1
        if size <= 0:
            continue
        whole = np.ones(size, bool)
        for k in range(1, n - 1):
            whole &= ~blank[k : k + size]
        # Neither end may reach into the next text: its last symbol is the blank that closes a text.
        whole &= owner[:size] == owner[n - 1 :]
        at = np.flatnonzero(whole)
        out.append((owner[at], slots(gram(symbol, at, n), bits)))
    return out, split


def shapes(split: words.Words, bits: int) -> np.ndarray:
    """A slot for the look of each word: letter case, digits, symbols, length, and whether a word just before was the same."""
    h, data = split.hashes(), split.data
    n = len(h)
    if not n:
        return np.zeros(0, np.int32)
    size = split.end - split.start
    kinds = (
        (data >= 0x41) & (data <= 0x5A),
        (data >= 0x61) & (data <= 0x7A) | (data >= 0x80),
        (data >= 0x30) & (data <= 0x39),
    )
    seen = []
    for k in kinds:
        total = np.concatenate([[0], np.cumsum(k)])
        seen.append(total[split.end] - total[split.start])
    upper, lower, digits = seen
    symbols = size - upper - lower - digits
    code = np.minimum(upper, 2) * (lower == 0) + 3 * (lower > 0) + 4 * np.minimum(digits, 1) + 8 * np.minimum(symbols, 3)
    code = code * 8 + np.minimum(size, 28) // 4
    owner = split.owner()
    for back in (1, 2, 3):
        same = np.zeros(n, bool)
        same[back:] = (h[back:] == h[:-back]) & (owner[back:] == owner[:-back])
        code = code * 2 + same
    return slots(code.astype(np.uint32) * np.uint32(0x9E3779B1), bits)
