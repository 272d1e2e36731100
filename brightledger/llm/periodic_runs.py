"""Periodic runs of words, found by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that no neighbouring word extends. Those of at least
``least`` words and ``times`` periods are reported, and ``collapse`` keeps the first period of each.

The automaton's links form a tree; the ancestors of the state of a prefix are the suffixes of that prefix. Each appended word accesses the path from its
state to the root and recolours it with the word's position, so a state's colour is the end of its last occurrence. The path consists of
segments of one colour; a link-cut tree holds each as one splay tree, so a path is walked segment by segment. Where a segment's longest suffix has
length L and its last occurrence ended p words earlier, the last L + p words have period p: a repetition if L >= p. No suffix of length L has
a closer occurrence, so p is its smallest period; L is the longest match, so the repetition starts where the run starts; and the last word at which it is seen is the run's end.

Ordinary text never reaches the automaton. A run of at least ``times`` periods consists of short windows that occur again within a fourth (1 / ``times``)
of its length; numpy marks the stretches of such windows, exactly, and only those are searched.

Defined cases: null text has no words and no runs; a null or repeated id is kept as it is, each row being a document of its own; an empty table
gives an empty result; a text of any length is read whole, by one task; white space is the six ASCII characters.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import text_or_empty

LEAST, TIMES = 6, 4

RUN = "start: bigint, length: bigint, period: bigint"
FOUND = f"doc_id bigint, n_words bigint, runs array<struct<{RUN}>>, text string"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_TYPES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN_TYPE)), ("text", pa.string())])
_ROWS = 512


def automaton(symbols: Sequence[Hashable]) -> tuple[list[int], list[int], list[int]]:
    """The suffix automaton: longest length and link of each state, and the state of each prefix. State 0 is the empty word."""
    longest, link, moves = [0], [-1], [{}]
    ends, last = [], 0
    for c in symbols:
        new = len(longest)
        longest.append(longest[last] + 1)
        link.append(0)
        moves.append({})
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if longest[p] + 1 == longest[q]:
                link[new] = q
            else:
                copy = len(longest)
                longest.append(longest[p] + 1)
                link.append(link[q])
                moves.append(moves[q].copy())
                link[q] = link[new] = copy
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
        last = new
        ends.append(new)
    return longest, link, ends


class Paths:
    """A tree whose paths to the root carry the time of their last access.

    Each path of one colour is a splay tree ordered by depth; ``up`` leads to the parent inside it or, from its top, to the state
    above the path. State 0, the root, is left out and stands for none. The top of a splay tree has the colour of its path.
    """

    def __init__(self, parent: list[int]):
        self.up = [max(0, p) for p in parent]
        self.left = [0] * len(parent)
        self.right = [0] * len(parent)
        self.colour = [-1] * len(parent)

    def splay(self, x: int) -> None:
        """Bring x to the top of its splay tree."""
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            y = up[x]
            if not y or left[y] != x and right[y] != x:
                return
            z = up[y]
            turns = [x]
            if z and (left[z] == y or right[z] == y):
                turns = [y, x] if (left[z] == y) == (left[y] == x) else [x, x]
            for a in turns:
                b = up[a]
                c = up[b]
                if left[b] == a:
                    left[b] = inner = right[a]
                    right[a] = b
                else:
                    right[b] = inner = left[a]
                    left[a] = b
                if inner:
                    up[inner] = b
                up[b], up[a] = a, c
                if c and left[c] == b:
                    left[c] = a
                elif c and right[c] == b:
                    right[c] = a
                else:  # b was the top
                    colour[a] = colour[b]

    def access(self, state: int, time: int) -> list[tuple[int, int]]:
        """The lowest state and the former colour of each segment from the state up; then the whole path gets the new colour."""
        met, below, x = [], 0, state
        while x:
            self.splay(x)
            met.append((x, self.colour[x]))
            if low := self.right[x]:  # deeper states keep their colour, as a path of their own
                self.colour[low] = self.colour[x]
            self.right[x] = below
            below, x = x, self.up[x]
        if below:
            self.colour[below] = time
            self.splay(state)
        return met


def repetitions(symbols: Sequence[Hashable], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` symbols and ``times`` >= 2 periods, in order of start and period."""
    longest, link, ends = automaton(symbols)
    paths = Paths(link)
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(ends):
        for x, end in paths.access(state, i):
            if end >= 0:
                p, n = i - end, longest[x]
                if n >= (times - 1) * p and n + p >= least:
                    found[i - n - p + 1, p] = n + p  # the last one stands
    return sorted((start, n, p) for (start, p), n in found.items())


def window_width(least: int = LEAST, times: int = TIMES) -> int:
    """The longest window of which every one inside a run occurs again one period away."""
    return min(max(least, times * q) - 2 * q + 1 for q in range(1, least // times + 3))


def stretches(keys: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """Ranges of words that hold every run. ``keys`` tell apart the windows of ``window_width`` words, also those of different texts."""
    n, width = len(keys), window_width(least, times)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    before, after = order[:-1][same], order[1:][same]
    near = np.full(n, n + width, np.int64)  # to the next equal window
    near[before] = after - before
    near[after] = np.minimum(near[after], after - before)
    alive = near < n + width
    while True:
        edge = np.flatnonzero(np.diff(np.concatenate([[False], alive, [False]]).astype(np.int8)))
        low, high = edge[0::2], edge[1::2]
        size = high - low + width - 1
        # In a run the nearest equal window is at most a period away.
        most = np.where(size >= least, size // times, 0)
        stays = alive.copy()
        stays[alive] = near[alive] <= np.repeat(most, high - low)
        if (stays == alive).all():
            return list(zip(low.tolist(), (low + size).tolist()))
        alive = stays


def _of_chunk(texts: list[bytes], least: int, times: int) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words and the runs of each text."""
    own, runs = [t.split() for t in texts], [[] for _ in texts]
    split, width = words.split(texts), window_width(least, times)
    owner, h = split.owner(), split.hashes()
    keys = words.window_hashes(h, width)
    if len(keys):
        # A window that crosses texts is like no other.
        crosses = owner[: len(keys)] != owner[width - 1 :]
        keys = words.mix(keys + owner[: len(keys)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), width)
        keys[crosses] = words.mix(np.flatnonzero(crosses).astype(np.uint64), width + 1)
        for low, high in stretches(keys, least, times):
            k = int(owner[low])
            first = int(split.first[k])
            found = repetitions(own[k][low - first : high - first], least, times)
            runs[k] += [(start + low - first, n, p) for start, n, p in found]
    return own, [sorted(set(r), key=lambda x: (x[0], x[2])) for r in runs]


def _kept(own: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return own
    step = np.zeros(len(own) + 1, np.int64)
    start, length, period = np.array(runs, np.int64).T
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    gone = np.cumsum(step) > 0
    return [w for w, g in zip(own, gone.tolist()) if not g]


def _collapse(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            for low, high in words.chunks(texts):
                own, runs = _of_chunk(texts[low:high], least, times)
                kept = [b" ".join(_kept(w, r)) for w, r in zip(own, runs, strict=True)]
                for a in range(0, high - low, _ROWS):
                    b = min(a + _ROWS, high - low)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(low + a, b - a), pa.array([len(w) for w in own[a:b]], pa.int64()),
                            pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in runs[a:b]], pa.list_(_RUN_TYPE)),
                            pa.array(kept[a:b], pa.binary()).cast(pa.string()),
                        ],
                        schema=_TYPES,
                    )

    return run


def collapse(docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start in words, length, period), text (the kept words, joined by one space)."""
    if times < 3 or least < 1:
        raise ValueError("times must be 3 at least")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(_collapse(least, times), FOUND)


def with_tail(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, a tenth of them with a periodic tail of their own words; the text of these is their words, joined by one space.

    With h the crc32 of the id in decimal and g = floor(h / 10), texts with h % 10 = 0 and n > 0 words repeat, from word a = g % n on, the next
    1 + floor((n - a) / (3 + g % 8)) words.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    w = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    marked = (h % 10 == 0) & F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    g = F.floor(h / 10)

    def planted(own, a):
        p = 1 + F.floor((F.size(own) - a) / (3 + g % 8))
        return F.array_join(F.transform(own, lambda x, i: F.when(i < a, x).otherwise(F.get(own, (a + (i - a) % p).cast("int")))), " ")

    # Arrays of one element bind the words and the place to a name, so that each is made once.
    bound = F.transform(F.array(w), lambda own: F.transform(F.array(g % F.size(own)), lambda a: planted(own, a))[0])[0]
    return docs.withColumn(text_col, F.when(marked, bound).otherwise(F.col(text_col)))


def digests(found: DataFrame) -> DataFrame:
    """One row per document: the number of its runs, its longest run, and checksums of all runs and of the text that is left."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("_b", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_b.start").alias("start"),
        (-F.col("_b.n")).alias("length"),
        F.col("_b.period").alias("period"),
        F.floor(-1000 * F.col("_b.n") / F.col("_b.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
