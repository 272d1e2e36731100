"""Removal of repeated passages, found by difference-cover anchors.

A window is ``width`` consecutive words of one document. A word is removed if a window that covers it has the same words as a
window that starts earlier: in a document with a smaller doc_id, or before it in the same document. Windows are judged on the input.

Hashing every window would shuffle a row for each word of the corpus. Instead, shorter windows, the anchors, are
hashed at positions whose residue modulo a period lies in a difference cover. For any two equal windows some shift below the period
brings both to such a position, so they share an aligned anchor. The steps:

1. Documents are put into units of about ``UNIT_BYTES`` of text, compressed and written to the shared folder.
2. Each unit asks of its distinct anchor hashes, one bit for each: does it occur more than once?
3. Matches extend from the anchors: only windows around a repeated anchor are hashed in full (96 bits). Each unit settles its own repeats and asks
   which of its firsts has an earlier one elsewhere.
4. Each unit marks the covered words and joins the others by one space.

Questions take two steps. Units belong to herds, as many as a herd has units. First a post, which stands for a herd and a wide range of hash values, folds what
the units of the herd ask to one question for each hash; then a bucket, a narrow range, meets one question from each herd. Answers go back the
same way. So messages grow as the power 1.5 of the text, not with its square, and a hash travels once per unit and once per herd however often it occurs:
a passage that fills a third of all rows is in its post and its bucket no larger than any other. Posts and buckets hold the same at any size of the text.

Defined cases: null text has no words; texts with fewer words than a window keep all; a null doc_id is smaller than any other; rows that
share a doc_id are ordered by unit and place in it, so one of them counts as the earlier; an empty table gives an
empty result; a text of any length is one part of one unit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import settle, text_or_empty

UNIT_BYTES = 4 << 20
#: Text for each post and each bucket, about 7 MB of anchor hashes.
BUCKET_BYTES = 16 << 20

#: Perfect difference sets: every residue of the period is a difference of two members.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

_LEAST_ID = np.iinfo(np.int64).min


def period_for(width: int) -> int:
    """The longest period that leaves anchors a third of the window."""
    return max(p for p in COVERS if p <= max(1, 2 * width // 3))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unit, held, size = TaskContext.get().partitionId() << 32, [], 0
    pack = zstandard.ZstdCompressor(level=3).compress

    def cut() -> pa.RecordBatch:
        nonlocal unit, held, size
        held.sort(key=lambda d: (d[0] is not None, d[0] or 0))
        texts = [t for _, t in held]
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([unit]),
                pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([pack(b"".join(texts))]),
                pa.array([size]),
            ],
            names=["unit", "ids", "sizes", "texts", "bytes"],
        )
        unit, held, size = unit + 1, [], 0
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = text.encode()
            if held and size + len(data) > UNIT_BYTES:
                yield cut()
            held.append((doc_id, data))
            size += len(data)
    if held:
        yield cut()


class Unit:
    """The windows of a unit."""

    def __init__(self, ids: list[int | None], sizes: list[int], packed: bytes, width: int):
        import zstandard

        data, at = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, sum(sizes))) if sum(sizes) else b"", 0
        self.ids, self.texts, self.width = ids, [], width
        for n in sizes:
            self.texts.append(data[at : at + n])
            at += n
        self.parts = parts = [words.split(self.texts[a:b]) for a, b in words.chunks(self.texts)]
        self.hash = np.concatenate([p.hashes() for p in parts] or [np.zeros(0, np.uint64)])
        self.counts = np.concatenate([np.diff(p.first) for p in parts] or [np.zeros(0, np.int64)])
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.place = np.arange(len(self.hash)) - np.repeat(self.first[:-1], self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.place  # words from here to the end of the document

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors; only documents with a whole window have any."""
        period = period_for(self.width)
        size = self.width - period + 1
        h = words.window_hashes(self.hash, size)
        at = np.zeros(period, bool)
        at[list(COVERS[period])] = True
        n = len(h)
        where = np.flatnonzero(at[self.place[:n] % period] & (self.left[:n] >= size) & (self.place[:n] + self.left[:n] >= self.width))
        return where, h[where]

    def windows(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions and hashes (64 and 32 bits) of the windows that hold an anchor at a position in ``repeated``."""
        n = len(self.hash) - self.width + 1
        if n <= 0 or not len(repeated):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        seen = np.zeros(len(self.hash) + 1, np.int64)
        seen[repeated + 1] = 1
        seen = np.cumsum(seen)
        period = period_for(self.width)
        where = np.flatnonzero((self.left[:n] >= self.width) & (seen[period : period + n] > seen[:n]))
        high = words.window_hashes(self.hash, self.width, seed=1)[where]
        # From other hashes of the words, so that two words that share one hash still differ.
        other = np.concatenate([p.hashes(seed=1) for p in self.parts])
        low = words.window_hashes(other, self.width, seed=2)[where] >> np.uint64(32)
        return where, high, low.astype(np.uint32)

    def owners(self, where: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, where, side="right") - 1


def _firsts(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows in order: the places of the first of each kind, in order of hash, and which windows are not the first."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
    later = np.ones(len(order), bool)
    later[order[new]] = False
    return order[new], later


def _cuts(keys: np.ndarray, buckets: int, low: int = 0, high: int | None = None) -> np.ndarray:
    """Where the buckets ``low`` to ``high`` (by default all) of ``buckets`` begin in sorted 64-bit keys, which all belong to them."""
    edges = np.array([(b << 64) // buckets for b in range(low + 1, buckets if high is None else high)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _answer(parts: list[dict] | None) -> np.ndarray:
    """The bits of a unit from all buckets, in order."""
    return np.concatenate([np.zeros(0, bool)] + [_flags(p["bits"], p["n"]) for p in parts or []])


def _messages(keys: np.ndarray, cut: np.ndarray, first: int, name: str, same: dict[str, int], more: dict) -> pa.RecordBatch:
    """A row for each range between cuts that holds keys: its number from ``first``, the values ``same`` and what ``more`` makes of the span."""
    some = np.flatnonzero(np.diff(cut))
    spans = [(cut[k], cut[k + 1]) for k in some]
    columns = {name: pa.array(some + first, pa.int64())}
    columns |= {k: pa.array(np.full(len(some), v, np.int64)) for k, v in same.items()}
    columns |= {k: pa.array([make(a, b) for a, b in spans], pa.binary()) for k, make in more.items()}
    return pa.RecordBatch.from_pydict(columns)


def _joined(group: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind)] + [np.frombuffer(x, kind) for x in group.column(column).to_pylist()])


class Anchors:
    """Questions of step 2: rows of keys, and which of them occur again in the same unit or herd."""

    COLUMNS = "keys binary, again binary"
    KEYS = "keys"

    @staticmethod
    def send(row: dict, width: int, posts: int) -> pa.RecordBatch:
        _, h = Unit(row["ids"], row["sizes"], row["texts"], width).anchors()
        keys, count = np.unique(h, return_counts=True)
        return Anchors._pack(keys, count > 1, _cuts(keys, posts), 0, "post", {"herd": row["herd"], "unit": row["unit"]})

    @staticmethod
    def _pack(keys: np.ndarray, again: np.ndarray, cut: np.ndarray, first: int, name: str, same: dict[str, int]) -> pa.RecordBatch:
        return _messages(keys, cut, first, name, same, {"keys": lambda a, b: keys[a:b].tobytes(), "again": lambda a, b: _bits(again[a:b])})

    @staticmethod
    def _kinds(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys, which of them occur more than once, and the place of each asked key among them."""
        keys = [np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()]
        again = np.concatenate([_flags(x, len(k)) for x, k in zip(group.column("again").to_pylist(), keys, strict=True)])
        kinds, at, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        many = count > 1
        many[at[again]] = True
        return kinds, many, at

    @staticmethod
    def fold(group: pa.Table, buckets: int, low: int, high: int, same: dict[str, int]) -> pa.RecordBatch:
        kinds, many, _ = Anchors._kinds(group)
        return Anchors._pack(kinds, many, _cuts(kinds, buckets, low, high), low, "bucket", same)

    @staticmethod
    def decide(group: pa.Table) -> np.ndarray:
        _, many, at = Anchors._kinds(group)
        return many[at]

    @staticmethod
    def back(group: pa.Table, answer: np.ndarray) -> np.ndarray:
        """Bits for what the units asked, from the bits for the distinct keys of their herd."""
        _, _, at = Anchors._kinds(group)
        return answer[at]


class Windows:
    """Questions of step 3: rows of windows with the document and the unit that each stands in."""

    COLUMNS = "high binary, low binary, docs binary, units binary"
    KEYS = "high"

    @staticmethod
    def send(row: dict, width: int, posts: int) -> pa.RecordBatch:
        unit = Unit(row["ids"], row["sizes"], row["texts"], width)
        where, high, low = _candidates(unit, row["anchors"])
        first, _ = _firsts(high, low)
        ids = np.array([_LEAST_ID if d is None else d for d in unit.ids], np.int64)
        docs = ids[unit.owners(where[first])]
        units = np.full(len(first), row["unit"], np.int64)
        return Windows._pack(high[first], low[first], docs, units, _cuts(high[first], posts), 0, "post", {"herd": row["herd"], "unit": row["unit"]})

    @staticmethod
    def _pack(high, low, docs, units, cut: np.ndarray, first: int, name: str, same: dict[str, int]) -> pa.RecordBatch:
        columns = {"high": high, "low": low, "docs": docs, "units": units}
        return _messages(high, cut, first, name, same, {k: lambda a, b, v=v: v[a:b].tobytes() for k, v in columns.items()})

    @staticmethod
    def _kinds(group: pa.Table) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
        """All asked windows, the places of the first of each kind, and which windows are not the first."""
        high, low = _joined(group, "high", np.uint64), _joined(group, "low", np.uint32)
        docs, units = _joined(group, "docs", np.int64), _joined(group, "units", np.int64)
        order = np.lexsort((units, docs))
        first, later = _firsts(high[order], low[order])
        not_first = np.empty(len(order), bool)
        not_first[order] = later
        return (high, low, docs, units), order[first], not_first

    @staticmethod
    def fold(group: pa.Table, buckets: int, low: int, high: int, same: dict[str, int]) -> pa.RecordBatch:
        rows, first, _ = Windows._kinds(group)
        rows = [x[first] for x in rows]
        return Windows._pack(*rows, _cuts(rows[0], buckets, low, high), low, "bucket", same)

    @staticmethod
    def decide(group: pa.Table) -> np.ndarray:
        return Windows._kinds(group)[2]

    @staticmethod
    def back(group: pa.Table, answer: np.ndarray) -> np.ndarray:
        _, first, later = Windows._kinds(group)
        later[first] = answer
        return later


def _replies(group: pa.Table, keys: str, flags: np.ndarray, columns: list[str]) -> pa.Table:
    """The bits for each row of a group, beside the columns that name the row."""
    sizes = [len(x) // 8 for x in group.column(keys).to_pylist()]
    ends = np.cumsum(sizes)
    bits = [_bits(flags[e - n : e]) for n, e in zip(sizes, ends, strict=True)]
    return pa.table({c: group.column(c) for c in columns} | {"n": pa.array(sizes, pa.int64()), "bits": pa.array(bits, pa.binary())})


def _ask(units: DataFrame, kind: type, width: int, posts: int, buckets: int) -> DataFrame:
    """(unit, post, n, bits): answers to what the units ask; ``buckets`` is a multiple of ``posts``."""
    own, per = kind.COLUMNS, buckets // posts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield kind.send(row, width, posts)

    def fold(group: pa.Table) -> pa.Table:
        herd, post = group.column("herd")[0].as_py(), group.column("post")[0].as_py()
        return pa.Table.from_batches([kind.fold(group, buckets, post * per, (post + 1) * per, {"herd": herd, "post": post})])

    def decide(group: pa.Table) -> pa.Table:
        return _replies(group, kind.KEYS, kind.decide(group), ["herd", "post", "bucket"])

    def back(asked: pa.Table, replies: pa.Table) -> pa.Table:
        answer = _answer(replies.sort_by("bucket").to_pylist())
        return _replies(asked, kind.KEYS, kind.back(asked, answer), ["unit", "post"])

    asked = units.mapInArrow(send, f"post long, herd long, unit long, {own}")
    folded = asked.groupBy("herd", "post").applyInArrow(fold, f"bucket long, herd long, post long, {own}")
    replies = folded.groupBy("bucket").applyInArrow(decide, "herd long, post long, bucket long, n long, bits binary")
    return asked.groupBy("herd", "post").cogroup(replies.groupBy("herd", "post")).applyInArrow(back, "unit long, post long, n long, bits binary")


def _candidates(unit: Unit, answer: list[dict] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    where, h = unit.anchors()
    _, at = np.unique(h, return_inverse=True)
    flags = _answer(answer)
    return unit.windows(where[flags[at]] if len(at) else where)


def _remove(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                unit = Unit(row["ids"], row["sizes"], row["texts"], width)
                where, high, low = _candidates(unit, row["anchors"])
                first, later = _firsts(high, low)
                later[first] = _answer(row["windows"])
                step = np.zeros(len(unit.hash) + width + 1, np.int64)
                step[where[later]] += 1
                step[where[later] + width] -= 1
                covered = np.cumsum(step)[: len(unit.hash)] > 0
                total = np.concatenate([[0], np.cumsum(covered)])
                gone = total[unit.first[1:]] - total[unit.first[:-1]]
                kept = []
                for k, text in enumerate(unit.texts):
                    own = text.split()
                    if gone[k]:
                        own = compress(own, ~covered[unit.first[k] : unit.first[k + 1]])
                    kept.append(b" ".join(own))
                for low_row in range(0, len(kept), 512):
                    part = slice(low_row, low_row + 512)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(unit.ids[part], pa.int64()), pa.array(unit.counts[part], pa.int64()),
                            pa.array(gone[part], pa.int64()), pa.array(kept[part], pa.binary()).cast(pa.string()),
                        ],
                        names=["doc_id", "n_words", "n_removed", "text"],
                    )

    return run


def remove_repeats(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, text (the words that stay, joined by one space)."""
    spark = docs.sparkSession
    units = settle(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
            _units, "unit long, ids array<long>, sizes array<long>, texts binary, bytes long"
        ),
        "units",
    )
    total, count = units.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    herd = max(1, math.isqrt(count))
    posts = -(-herd * UNIT_BYTES // BUCKET_BYTES)
    # At least a bucket for each shuffle partition, and as many for each post.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // BUCKET_BYTES))
    buckets = posts * -(-buckets // posts)
    units = units.withColumn("herd", F.pmod(F.xxhash64("unit"), F.lit(max(1, -(-count // herd)))))

    def by_unit(answers: DataFrame, name: str) -> DataFrame:
        return answers.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("post", "n", "bits"))).alias(name))

    anchors = settle(_ask(units, Anchors, width, posts, buckets), "anchors")
    known = units.join(by_unit(anchors, "anchors"), "unit", "left")
    windows = _ask(known, Windows, width, posts, buckets)
    return known.join(by_unit(windows, "windows"), "unit", "left").mapInArrow(
        _remove(width), "doc_id long, n_words long, n_removed long, text string"
    )
