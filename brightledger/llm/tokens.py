"""Token ids of whole texts from a public tokenizer file.

The ids are those of ``Tokenizer.encode`` over the whole text. A byte-level tokenizer of this kind never
joins a character that is not white space with white space after it, so a text may be cut there. Most
pieces have been seen before, so each worker keeps the ids of about ``MEMO`` pieces, of ``MEMO_BYTES`` at most, and has the library
encode only new ones, many of them in one call. A million pieces take some 300 MB; fewer cost time, as those forgotten are encoded again. Short pieces are cut and
found by numpy, in a table that holds all their bytes; a piece becomes a Python string only if it is long, new or has lost its place in the table to another one. A new piece that ends in punctuation after a letter or digit is put together from its two parts, as such a
tokenizer never joins those either. Texts or tokenizers for which the cut is not known to be safe
are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import words

MEMO = 1_200_000
#: Characters of the kept pieces plus bytes of their ids: long pieces, such as texts without white space, count by their size.
MEMO_BYTES = 64 << 20
#: Bytes of texts that become Python objects at a time.
PORTION = 4 << 20
_JOIN = 1 << 16

_pieces = re.compile(r"\s*\S+|\s+").findall
# White space for Python, but not for the tokenizer.
_odd = re.compile("[\x1c-\x1f]").search
# These and white space of more than one byte.
_rare = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search

#: Rows of the table of short pieces, as a power of two, and the bytes of the longest piece in it.
PLACES, SHORT = 18, 15


class _Numbers(dict):
    """Numbers for pieces, in the order in which they are first asked for."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    ``special_as_text``: strings such as ``<|endoftext|>`` inside a text are ordinary text; by default they become
    the special token, as the library does it. ``memo``: how many pieces are kept, ``MEMO`` unless given.
    """

    def __init__(self, path: str, special_as_text: bool = False, memo: int | None = None):
        from tokenizers import Tokenizer

        self.most = memo

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.cut_is_safe = bool(
            plain
            and not spec.get("normalizer")
            and spec["model"]["type"] == "BPE"
            and not any(re.search(r"\s", a) or not a.isascii() for a in added)
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
        )
        if self.cut_is_safe:
            # One character of a byte-level token stands for one byte.
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.width = np.zeros(max(vocab.values()) + 1, np.int64)
            for token, i in vocab.items():
                self.width[i] = len(token)
        # Punctuation that is a token's part by itself: an apostrophe may begin a contraction, and other strings may hold some.
        self.tails = "".join(c for c in string.punctuation if c != "'" and not any(c in a for a in added))
        self._forget(0)

    def _ids(self, text: str) -> np.ndarray:
        # Without offsets, which nothing here needs.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.dtype("<u4"))

    def _forget(self, keep: int) -> None:
        """Keep the first pieces only: the earlier a piece was met, the more frequent it tends to be."""
        if not keep:
            self.memo, self.flat, self.used, self.chars = _Numbers(), np.zeros(1 << 14, np.dtype("<u4")), 0, 0
            self.begin, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
            # Of a short piece at its place: its bytes and their number, as two numbers, and its own number.
            self.table = np.zeros((1 << PLACES, 3), np.uint64)
        else:
            self.memo = _Numbers(islice(self.memo.items(), keep))
            self.used = int((self.begin[:keep] + self.size[:keep]).max())
            self.chars = sum(map(len, self.memo))
            self.flat = self.flat[: max(self.used, 1 << 14)].copy()
            self.table[self.table[:, 2] >= keep] = 0

    def _bound(self) -> None:
        """Forget pieces if they are too many or take too much."""
        most = self.most or MEMO
        if len(self.memo) > most:
            self._forget(most // 2)
        if self.chars + 4 * self.used > MEMO_BYTES:
            # As many of the first pieces as take half of that. Ids lie in about the order of their pieces, so each is counted with all before it.
            upto = np.cumsum([len(p) for p in self.memo]) + 4 * np.maximum.accumulate((self.begin + self.size)[: len(self.memo)])
            self._forget(int(np.searchsorted(upto, MEMO_BYTES // 2)))

    def _store(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep the ids of pieces, which lie one after the other; those of piece k are ``flat[begin[k] : begin[k] + size[k]]``."""
        while len(self.memo) > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (self.begin, self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), self.flat.dtype)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.used += len(ids)

    def _learn(self, new: list[str], numbers: list[int]) -> None:
        """Encode new pieces in one call. Those without leading white space get a line feed, whose id is dropped again."""
        lead = [p if p[0].isspace() else "\n" + p for p in new]
        ids = self._ids("".join(lead))
        ends = np.cumsum(self.width[ids])
        cuts = np.searchsorted(ends, np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in lead])) + 1
        sizes = np.diff(cuts, prepend=0)
        added = np.array([full is not p for p, full in zip(new, lead, strict=True)])
        own = np.ones(len(ids), bool)
        own[(cuts - sizes)[added]] = False
        self._store(np.array(numbers), ids[own], sizes - added)

    def _learn_all(self) -> None:
        """The ids of all pieces that are new, parts before what they make up."""
        held, whole, size, at = [], [], 0, len(self.memo) - len(self.memo.new)
        made, heads, tails = [], [], []
        number, new = self.memo.__getitem__, self.memo.new
        for k, p in enumerate(new, at):  # grows meanwhile by parts, which have no parts themselves
            head = p.rstrip(self.tails)
            if head and len(head) < len(p) and head[-1].isalnum():
                made.append(k)
                heads.append(number(head))
                tails.append(number(p[len(head) :]))
            elif p.isspace():
                ids = self._ids(p)
                self._store(np.array([k]), ids, np.array([len(ids)]))
            else:
                held.append(p)
                whole.append(k)
                size += len(p)
                if size > _JOIN:
                    self._learn(held, whole)
                    held, whole, size = [], [], 0
        if held:
            self._learn(held, whole)
        if made:
            parts = np.stack([heads, tails], axis=1)
            self._store(np.array(made), self._flat(parts.reshape(-1)), self.size[parts].sum(1))
        self.chars += sum(map(len, self.memo.new))
        self.memo.new = []

    def _flat(self, code: np.ndarray) -> np.ndarray:
        """The ids of pieces, one after the other."""
        sizes = self.size[code]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.begin[code] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def _ask(self, pieces: list[str]) -> np.ndarray:
        """The numbers of pieces, new ones too."""
        return np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the pieces of each text. All white space in these texts is one byte long."""
        parts = [t.encode() for t in texts]
        raw = b"".join(parts)
        upto = np.cumsum([0, *map(len, parts)])
        n = len(raw)
        if not n:
            return [np.zeros(0, np.int64) for _ in texts]
        padded = np.frombuffer(raw + bytes(16), np.uint8)
        space = np.take(words._SPACE, padded[:n])
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[upto[:-1][upto[:-1] < n]] = True
        start = np.flatnonzero(cut)
        size = np.diff(start, append=n)
        # All bytes of a short piece and their number.
        eight = np.ndarray(n + 9, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        low = eight[start] & words._LOW[np.minimum(size, 8)]
        high = eight[start + 8] & words._LOW[np.clip(size - 8, 0, 7)] | np.minimum(size, SHORT + 1).astype(np.uint64) << np.uint64(56)
        place = (words.mix(low ^ words.mix(high)) >> np.uint64(64 - PLACES)).astype(np.int64)
        held = np.take(self.table, place, axis=0)
        code = held[:, 2].astype(np.int64)
        rest = np.flatnonzero((held[:, 0] != low) | (held[:, 1] != high) | (size > SHORT))
        code[rest] = self._ask([raw[a:b].decode() for a, b in zip(start[rest].tolist(), (start + size)[rest].tolist(), strict=True)])
        rest = rest[size[rest] <= SHORT]
        self.table[place[rest]] = np.stack([low[rest], high[rest], code[rest].astype(np.uint64)], axis=1)
        return np.split(code, np.searchsorted(start, upto[1:-1]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        self._bound()
        codes: list[np.ndarray | None] = [None] * len(texts)
        if self.cut_is_safe:
            rare = {i for i, t in enumerate(texts) if _rare(t)}
            plain = [i for i in range(len(texts)) if i not in rare]
            for i, c in zip(plain, self._numbers([texts[i] for i in plain]), strict=False):
                codes[i] = c
            for i in rare:
                codes[i] = None if _odd(texts[i]) else self._ask(_pieces(texts[i]))
        if self.memo.new:
            self._learn_all()
        whole = [c is None for c in codes]
        codes = [np.zeros(0, np.int64) if c is None else c for c in codes]
        code = np.concatenate(codes or [np.zeros(0, np.int64)])
        ids = self._flat(code)
        upto = np.concatenate([[0], np.cumsum(self.size[code])])[np.cumsum([0] + [len(c) for c in codes])].tolist()
        return [
            self._ids(t).tobytes() if alone else ids[low:high].tobytes()
            for t, alone, low, high in zip(texts, whole, upto, upto[1:], strict=False)
        ]


@lru_cache(maxsize=2)
def encoder(path: str, special_as_text: bool = False, memo: int | None = None) -> Encoder:
    """The encoder of this Python process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, special_as_text, memo)


def ranges(texts: pa.Array, rows: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts, none null, of ``rows`` at most, and of one text or ``PORTION`` bytes."""
    ends, low = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while low < len(ends):
        fits = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PORTION, "right"))
        high = min(len(ends), low + min(rows, max(1, fits - low)))
        yield low, high
        low = high


def portions(batch: pa.RecordBatch, rows: int) -> Iterator[tuple[list, list[str]]]:
    """The ids and texts of a batch (its two columns, no text null) as lists for each of the ranges."""
    for low, high in ranges(batch.column(1), rows):
        part = batch.slice(low, high - low)
        yield part.column(0).to_pylist(), part.column(1).to_pylist()
