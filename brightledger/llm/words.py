"""Words of whole texts as numpy arrays: positions, 64-bit hashes and rolling hashes of windows.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Words of up to 16 bytes are hashed from two numbers that hold all their bytes; longer ones by xxh3, so no pattern of letters gives equal hashes. All work is vectorised over a chunk of texts; a chunk is about ``CHUNK_BYTES``, and a longer
text is a chunk of its own, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_WINDOW_BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64
#: The lowest n bytes of a 64-bit number.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k < size."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _powers_for(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, 1 << max(12, (n - 1).bit_length() if n > 1 else 1))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser), one for each seed."""
    z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@dataclass
class Words:
    """Words of a chunk of texts, in order. ``first[d]`` to ``first[d + 1]`` are the words of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes, one for each seed."""
        import xxhash

        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(16, np.uint8)])
        eight = np.ndarray(len(self.data) + 9, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        low = eight[self.start] & _LOW[np.minimum(size, 8)]
        high = eight[self.start + 8] & _LOW[np.clip(size - 8, 0, 8)]
        h = mix(mix(low, 2 * seed) ^ mix(high + size.astype(np.uint64), 2 * seed + 1), seed)
        long = np.flatnonzero(size > 16)
        if len(long):
            data = memoryview(self.data)
            spans = zip(self.start[long].tolist(), self.end[long].tolist(), strict=True)
            h[long] = [xxhash.xxh3_64_intdigest(data[a:b], seed) for a, b in spans]
        return h

    def owner(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def place(self) -> np.ndarray:
        """The position of each word in its own text."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], np.diff(self.first))


def window_hashes(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A hash of each run of ``width`` values of h; item i covers h[i:i + width]."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    power, inverse = _powers_for(_WINDOW_BASE, n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((mix(h, seed) if seed else h) * power[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * inverse[: n - width + 1], seed + 1)


def split(texts: list[bytes], between: np.ndarray = _SPACE) -> Words:
    """The words of a chunk of texts. ``between`` says of each byte whether it stands between words; a line feed does."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = np.empty(len(data) + 1, bool)
    blank[0] = True
    np.take(between, data, out=blank[1:])
    turn = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = turn[0::2], turn[1::2]
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return Words(data, start, end, np.searchsorted(start, begins))


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    low, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield low, i
            low, held = i, 0
        held += len(t) + 1
    if low < len(texts):
        yield low, len(texts)
