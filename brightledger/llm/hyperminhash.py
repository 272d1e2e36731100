"""HyperMinHash signatures of word shingles, as numpy arrays.

A signature has ``REGISTERS`` one-byte registers. Each is the smallest hash of the shingles in one bucket, kept as its count of leading
zeros (high four bits) and the four bits after the leading one. Sets with many shingles deal them out to 256 buckets by one hash;
smaller sets use fewer buckets, so that each gets at least four shingles on average, and several rounds of hashes. How many is the
signature's ``level``; only signatures of the same level can be compared. Of two sets that are similar enough, the smaller has at least
``share`` times the size of the larger, so a set gets a signature for its own level and for that of the largest set it can match.
"""

from __future__ import annotations

import numpy as np

from . import words

REGISTERS = 256
#: Registers to a band, and bands. At a similarity of 0.8 a pair has no common band with probability 3e-6.
BAND, BANDS = 6, 42
MISSED = 3e-6
_MANTISSA = 4
#: From the paper on HyperMinHash (Yu and Weber): the chance that registers of disjoint sets agree, times 2**mantissa.
_CHANCE = 0.169919487159739

_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[0x41:0x5B] += 0x20
_SEEDS = words.mix(np.arange(REGISTERS, dtype=np.uint64), 101)
_BAND_FACTORS = words.mix(np.arange(BAND, dtype=np.uint64), 103) | np.uint64(1)


def fold_case(data: bytes) -> bytes:
    """Lower-case A-Z only."""
    return data.translate(_UPPER.tobytes())


def shingle_sets(texts: list[bytes], size: int = 2) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of ``size`` words; a shorter text is one run, an empty one none."""
    out: list[np.ndarray] = []
    for low, high in words.chunks(texts):
        split = words.split([fold_case(t) for t in texts[low:high]])
        h = split.hashes()
        runs = words.window_hashes(h, size)
        for a, b in zip(split.first[:-1].tolist(), split.first[1:].tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(runs[a : b - size + 1]))
            elif b > a:
                out.append(words.window_hashes(h[a:b], b - a, seed=b - a))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def level(n: int) -> int:
    """The binary logarithm of the number of buckets for n shingles."""
    return max(0, min(REGISTERS.bit_length() - 1, (n // 4).bit_length() - 1))


def band_rows(share: float) -> int:
    """The most registers to a band, ``BAND`` at most, with which a pair at the similarity ``share`` has no common band with probability ``MISSED`` at most."""
    for rows in range(BAND, 0, -1):
        if (1 - share**rows) ** (REGISTERS // rows) <= MISSED:
            return rows
    raise ValueError(f"{REGISTERS} registers do not find pairs of similarity {share}")


def levels(n: int, share: float) -> list[int]:
    """The levels at which a set of n shingles can meet a set that is as large or larger."""
    if not n:
        return []
    return list(range(level(n), level(int(n / share + 1e-9)) + 1))


def registers(shingles: np.ndarray, at: int) -> np.ndarray:
    """The registers of a set that is not empty, at a level."""
    buckets = 1 << at
    rounds = REGISTERS // buckets
    h = words.mix(shingles[None, :] ^ _SEEDS[:rounds, None])
    if at:
        place = (h >> np.uint64(64 - at)).astype(np.int64)
        rest = h << np.uint64(at)
    else:
        place, rest = np.zeros(h.shape, np.int64), h
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    place += (np.arange(rounds) * buckets)[:, None]
    np.minimum.at(least, place.ravel(), rest.ravel())
    zeros = 64 - np.frexp(least.astype(np.float64))[1]
    zeros = np.clip(zeros, 0, 63).astype(np.uint64)
    bits = (least << zeros << np.uint64(1)) >> np.uint64(64 - _MANTISSA)
    out = (np.minimum(zeros, 15).astype(np.uint8) << _MANTISSA) | bits.astype(np.uint8)
    return out


def band_keys(register: np.ndarray, at: int, band: int = BAND) -> np.ndarray:
    """A 64-bit key of each band of a signature."""
    bands, factors = REGISTERS // band, _BAND_FACTORS[:band]
    rows = register[: band * bands].reshape(bands, band).astype(np.uint64) + np.uint64(1)
    mixed = (words.mix(rows * factors, 107) * factors).sum(axis=1, dtype=np.uint64)
    return words.mix(mixed + np.uint64(at << 32) + np.arange(bands, dtype=np.uint64), 109)


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity by the share of equal registers, less the agreement expected by chance. Rows are signatures."""
    ratio = np.maximum(sizes_a, sizes_b) / np.maximum(1, np.minimum(sizes_a, sizes_b))
    chance = _CHANCE / (1 << _MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sets' similarity is at least ``percent`` of a hundred. Both are sorted."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = int(np.isin(a, b, assume_unique=True).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)
