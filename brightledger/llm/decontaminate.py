"""Benchmark passages in documents, found by spaced seeds.

A seed is a fixed mask over consecutive words: its hash takes the words under a 1 and ignores those under a 0, so a
replaced word under a 0 does not hide a match. Documents and benchmark items are hashed under the same masks. Around
each common hash the item is laid over the document, and the two overlap if some run of ``SPAN`` words (the whole item if
that is shorter) has at least ``SHARE`` equal words in place. The masks miss no such run: with at most a fifth of 13 words
replaced, three or more unbroken stretches hold the rest, and one of them is five long or two of four words
stand side by side. Whole items of 10 and 11 words are sought by any three unbroken words as well, as 2 of so few words can leave
stretches of three.

Words are compared in lower case without ASCII punctuation. Items of at most ``SLICE_BYTES`` together go to the tasks that read
the documents. The seeds of a larger benchmark are rows that are joined with those of the documents: each carries the words
around it, which hold every run of ``SPAN`` words that the seed can belong to, so a pair of seeds is verified by itself. Seeds of documents whose bit is not set in a
table of the benchmark's seeds (two of 32 bits or more for each, 32 MB at most) never leave their task. Equal texts are one text on both sides. The work grows with the meetings of seeds.
Both ways give the same rows, in one pass over the documents.

Defined cases: null and empty texts overlap with nothing; items under ``LEAST`` words are sought
word by word, without replaced ones, and those without a word not at all; a null or repeated id is kept as it is; an empty table on either side gives no overlap; whole texts of
any length are searched.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import settle

MASKS = ("11111", "111101", "101111")
SPAN, SHARE, LEAST = 13, 0.8, 8
#: Each mask with the sizes of the items that it seeks.
SEEDS = tuple((m, (LEAST, None)) for m in MASKS) + (("111", (10, 11)),) + tuple(("1" * n, (n, n)) for n in range(1, LEAST))
SLICE_BYTES = 4 << 20
_TABLE = 1 << 22
#: Bits of the table of a joined benchmark's seeds, at least and at most.
_BITS = (1 << 20, 1 << 28)
_SEED = "key binary, mask int, hash long, place long, size long, around binary"
_SEED_TYPES = pa.schema([("key", pa.binary()), ("mask", pa.int32()), *((c, pa.int64()) for c in ("hash", "place", "size")), ("around", pa.binary())])
_MET = "key binary, item binary, doc_word long, item_word long, n_words long, n_equal long"
_MET_TYPES = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in _MET.split(", ")])

HITS = "doc_id long, item_id long, doc_word long, item_word long, n_words long, n_equal long"
_HIT_TYPES = pa.schema([(c.split()[0], pa.int64()) for c in HITS.split(", ")])
_PUNCTUATION = string.punctuation.encode()


def normal(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(None, _PUNCTUATION)


def seed_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """The hash under the mask at each word; item i covers h[i:i + len(mask)]."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total += h[k : k + n] * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
    return words.mix(total, int(mask, 2))


class Items:
    """Seeds and words of benchmark items."""

    def __init__(self, rows: list[tuple]):
        split = words.split([normal(t) for _, t, *_ in rows])
        self.hash, self.first = split.hashes(), split.first
        self.ids = [i for i, *_ in rows]
        self.size = np.diff(self.first)
        owner, place = split.owner(), split.place()
        self.seeds = []
        for mask, (least, most) in SEEDS:
            s = seed_hashes(self.hash, mask)
            n = len(s)
            own = owner[:n]
            inside = (own == owner[len(mask) - 1 : len(mask) - 1 + n]) & (self.size[own] >= least)
            if most is not None:
                inside &= self.size[own] <= most
            at = np.flatnonzero(inside)
            if not len(at):
                continue
            order = at[np.argsort(s[at], kind="stable")]
            key, low = np.unique(s[order], return_index=True)
            seen = np.zeros(_TABLE, bool)
            seen[key & np.uint64(_TABLE - 1)] = True
            self.seeds.append((mask, seen, key, np.append(low, len(order)), owner[order], place[order]))

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, word of the text, word of the item, words of the run, equal words), the best run of each text and item."""
        split = words.split(texts)
        h = split.hashes()
        owner = split.owner()
        best: list[np.ndarray] = []
        for mask, seen, key, low, item, place in self.seeds:
            s = seed_hashes(h, mask)
            if not len(s) or not len(key):
                continue
            at = np.flatnonzero(seen[s & np.uint64(_TABLE - 1)])
            at = at[owner[at] == owner[at + len(mask) - 1]]
            k = np.searchsorted(key, s[at])
            hit = key[np.minimum(k, len(key) - 1)] == s[at]
            at, k = at[hit], k[hit]
            count = low[k + 1] - low[k]
            # A part of the meetings at a time, however often a seed occurs on either side.
            upto = np.cumsum(count)
            for a, b in _slices(upto, _MEETINGS):
                n = count[a:b]
                entry = np.repeat(low[k[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                # Where the item's first word would lie; one row for each text, item and shift.
                best.append(self._verify(split.first, h, np.repeat(owner[at[a:b]], n), item[entry], np.repeat(at[a:b], n) - place[entry]))
        if not best:
            return []
        return list(map(tuple, _best(np.concatenate(best))[:, [0, 1, 3, 4, 5, 6]].tolist()))

    def _verify(self, first: np.ndarray, h: np.ndarray, text: np.ndarray, item: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """(text, item, shift, word of the text, word of the item, words of the run, equal words) of the best overlap of each text and item, by equal words along the diagonals."""
        # Distinct places: the owner of the first word and the item tell the rest.
        key = np.unique((shift + self.size.max(initial=0)) * len(self.ids) + item)
        shift, item = key // len(self.ids) - self.size.max(initial=0), key % len(self.ids)
        text = np.searchsorted(first, np.maximum(shift, 0), side="right") - 1
        parts = []
        for own in (text, text + 1):  # a shift before the first word of a text lies in the text before
            ok = own < len(first) - 1
            t, i, d = own[ok], item[ok], shift[ok]
            low, high = np.maximum(d, first[t]), np.minimum(d + self.size[i], first[t + 1])
            span = np.minimum(SPAN, self.size[i])
            fits = (high - low >= span) & ((own[ok] == text[ok]) | (d < first[t]))
            parts.append(np.stack([t, i, d, low, high, span], axis=1)[fits])
        rows = np.concatenate(parts)
        out = []
        for a, b in _slices(np.cumsum(rows[:, 4] - rows[:, 3]), _MEETINGS):
            t, i, d, low, high, span = rows[a:b].T
            n = high - low
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(low - ends + n, n)
            equal = h[at] == self.hash[at + np.repeat(self.first[i] - d, n)]
            total = np.concatenate([[0], np.cumsum(equal)])
            # The runs of ``span`` words of each row, and the best of them, the first if several are.
            runs = n - span + 1
            stop = np.cumsum(runs)
            begin = np.arange(stop[-1]) + np.repeat(ends - n - stop + runs, runs)
            value = total[begin + np.repeat(span, runs)] - total[begin]
            big = int(runs.max()) + 1
            score = value * big + (np.repeat(stop, runs) - np.arange(stop[-1]))
            top = np.maximum.reduceat(score, stop - runs)
            same, place = top // big, runs - top % big
            least = np.where(self.size[i] >= LEAST, SHARE * span, span)
            ok = same >= least
            found = np.stack([t, i, d, low + place - first[t], low + place - d, span, same], axis=1)
            out.append(_best(found[ok]))
        return np.concatenate(out) if out else np.zeros((0, 7), np.int64)


#: Words or meetings that are looked at together.
_MEETINGS = 1 << 19


def _slices(upto: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` together, from running sums; one larger row is a range of its own."""
    low, n = 0, len(upto)
    while low < n:
        before = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield low, high
        low = high


def _best(rows: np.ndarray) -> np.ndarray:
    """Of each text and item the row with most equal words, and of these the one that starts first."""
    rows = rows[np.lexsort((rows[:, 2], -rows[:, 6], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


@lru_cache(maxsize=2)
def _items(rows: tuple) -> Items:
    return Items(list(rows))


def folded(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The items with a text, equal rows as one: id, text, n (how often the row is there)."""
    picked = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return picked.groupBy("id", "text").agg(F.count(F.lit(1)).alias("n"))


def small(rows: DataFrame) -> tuple | None:
    """All folded items, or None if they are larger than SLICE_BYTES."""
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    return tuple((r.id, r.text, r.n) for r in rows.collect()) if total <= SLICE_BYTES else None


def _by_chunk(items: Items, texts: list[str | None]) -> Iterator[tuple]:
    data = [normal(t) for t in texts]
    for low, high in words.chunks(data):
        for text, *rest in items.search(data[low:high]):
            yield (low + text, *rest)


def _seeds(of_items: bool, bits: Broadcast | None = None):
    """Texts to their seeds, those of documents only if their bits are set: place and size in words, and the hashes of the words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, data = batch.column(0), [normal(t) for t in batch.column(1).to_pylist()]
            for low, high in words.chunks(data):
                split = words.split(data[low:high])
                h, owner, place, size = split.hashes(), split.owner(), split.place(), np.diff(split.first)
                for k, (mask, (least, most)) in enumerate(SEEDS):
                    s = seed_hashes(h, mask)
                    n, own = len(s), owner[: len(s)]
                    ok = own == owner[len(mask) - 1 : len(mask) - 1 + n]
                    if of_items:
                        ok &= (size[own] >= least) & (size[own] <= (most or size.max(initial=0)))
                    else:
                        ok &= _set(bits.value, s)
                    found = np.flatnonzero(ok)
                    for a in range(0, len(found), 1 << 14):
                        at = found[a : a + (1 << 14)]
                        around = at[:, None] + np.arange(1 - SPAN, len(mask) + SPAN - 1)
                        around = h[np.clip(around, 0, len(h) - 1)]
                        ends = np.arange(len(at) + 1, dtype=np.int32) * np.int32(8 * around.shape[1])
                        yield pa.RecordBatch.from_arrays(
                            [
                                keys.take(pa.array(low + owner[at])),
                                pa.array(np.full(len(at), k, np.int32)),
                                *(pa.array(c.astype(np.int64)) for c in (s[at].view(np.int64), place[at], size[owner[at]])),
                                pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(around.tobytes())]),
                            ],
                            schema=_SEED_TYPES,
                        )

    return run


def _set(bits: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set."""
    out = np.ones(len(s), bool)
    for x in (s, s >> np.uint64(32)):
        x = x & np.uint64(8 * len(bits) - 1)
        out &= (bits[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def _bits(seeds: DataFrame) -> np.ndarray:
    """Two bits for each hash, in a table of bounded size."""
    least, most = _BITS
    size = min(most, max(least, 1 << (32 * seeds.count()).bit_length()))
    both = F.array(*(F.pmod(h, F.lit(size)) + 1 for h in (F.col("hash"), F.shiftrightunsigned("hash", 32))))
    x = seeds.select(F.explode(both).alias("x"))
    parts = x.groupBy(F.bitmap_bucket_number("x").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for r in parts.toLocalIterator():
        out[(r.part - 1) * len(r.bits) : r.part * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return out


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of equal seeds to the best run around each that is equal enough."""
    for batch in batches:
        masks = batch.column("mask").to_numpy()
        for k in np.unique(masks):
            part = batch.filter(pa.array(masks == k))
            width = len(SEEDS[k][0]) + 2 * (SPAN - 1)
            places, inside, values = [], [], []
            for side in ("", "item_"):
                at = part.column(side + "place").to_numpy() - (SPAN - 1)
                j = at[:, None] + np.arange(width)
                places.append(at)
                inside.append((j >= 0) & (j < part.column(side + "size").to_numpy()[:, None]))
                values.append(np.frombuffer(b"".join(part.column(side + "around").to_pylist()), np.uint64).reshape(-1, width))
            shared = inside[0] & inside[1]
            size = part.column("item_size").to_numpy()
            span = np.minimum(SPAN, size)
            row, start = np.arange(len(size)), np.arange(width)
            stop = np.minimum(start + span[:, None], width)
            count = [np.pad(np.cumsum(x, axis=1), ((0, 0), (1, 0))) for x in (shared, shared & (values[0] == values[1]))]
            both, same = (c[row[:, None], stop] - c[:, :-1] for c in count)
            same = np.where(both == span[:, None], same, -1)
            top = same.argmax(axis=1)
            best = same[row, top]
            ok = best >= np.where(size >= LEAST, SHARE * span, span)
            numbers = (places[0] + top, places[1] + top, span, best)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("item"), *(pa.array(c.astype(np.int64)) for c in numbers)], schema=_MET_TYPES
            ).filter(pa.array(ok))


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text)).alias("key")


def _joined(texts: DataFrame, items: DataFrame) -> DataFrame:
    """The best overlap of each two texts, by a join of their seeds. Texts are named by a digest."""
    spark = texts.sparkSession
    distinct = items.select("text").distinct()
    sought = settle(distinct.select(_key(F.col("text")), "text").mapInArrow(_seeds(True), _SEED), "item-seeds")
    bits = spark.sparkContext.broadcast(_bits(sought))
    # Copies of a document are folded in their tasks before anything is moved.
    met = texts.select(_key(F.col("text")), "text").where("text is not null").mapInArrow(_seeds(False, bits), _SEED).distinct()
    other = sought.select("mask", "hash", F.col("key").alias("item"), *(F.col(c).alias(f"item_{c}") for c in ("place", "size", "around")))
    pairs = met.join(other, ["mask", "hash"]).drop("hash").mapInArrow(_overlaps, _MET)
    order = F.struct((-F.col("n_equal")).alias("less"), (F.col("doc_word") - F.col("item_word")).alias("shift"), "doc_word", "item_word", "n_words", "n_equal")
    best = pairs.groupBy("key", "item").agg(F.min(order).alias("best"))
    return best.select("key", "item", "best.doc_word", "best.item_word", "best.n_words", "best.n_equal")


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and item that overlap: the best run, where it starts in both, its words and equal words."""
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    every = folded(benchmark)
    rows = small(every)
    if rows is None:
        met = _joined(picked.select("text"), every)
        named = every.select(_key(F.col("text")).alias("item"), F.col("id").alias("item_id"), F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
        own = picked.select("doc_id", _key(F.col("text")))
        return own.join(met, "key").join(named, "item").select(*(c.split()[0] for c in HITS.split(", ")))
    shared = spark.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(shared.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = _by_chunk(items, batch.column(1).to_pylist())
            # One row for each row of the benchmark; a repeated one is searched once.
            hits = itertools.chain.from_iterable(itertools.repeat((ids[t], items.ids[i], *rest), shared.value[i][2]) for t, i, *rest in found)
            while some := list(itertools.islice(hits, 1 << 16)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some, strict=True)], schema=_HIT_TYPES)

    return picked.mapInArrow(run, HITS)


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that overlap with no item, with all their columns. Beside items of at most SLICE_BYTES, rows are not moved."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    every = folded(benchmark)
    rows = small(every)
    if rows is None:
        text = F.col(text_col).cast("string")
        found = _joined(docs.select(text.alias("text")), every).select("key").distinct()
        return docs.select(F.struct("*").alias("row"), _key(text)).join(found, "key", "left_anti").select("row.*")
    shared = spark.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(shared.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[t for t, *_ in _by_chunk(items, batch.column(at).to_pylist())]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
