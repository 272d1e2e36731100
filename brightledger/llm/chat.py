"""Conversations as one training text each, with a loss mask from token offsets.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts every ``<|`` gets a backslash before the
bar, and one that already has backslashes gets one more, so that no text can imitate a control string and the way back is exact. In
a role, backslashes and line feeds are written ``\\\\`` and ``\\n`` before that.

The whole conversation is encoded once, with offsets. The characters of assistant texts are sorted spans; each token finds its span by
binary search, and it is under the loss mask if the two meet. What they share is kept as character spans too, so the text under the
mask is exact even where a token reaches over an edge.

A conversation is one value of the result and is gathered as such. Defined cases: null text and null role count as empty; turns are ordered by
turn (null first), then role, then text, and repeated rows stay; a null conv_id is a conversation; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"

FORMATTED = "conv_id long, text string, ids array<int>, loss_mask array<boolean>, loss_starts array<long>, loss_ends array<long>"
_FORMATTED_TYPES = pa.schema(
    [("conv_id", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_()))]
    + [(c, pa.list_(pa.int64())) for c in ("loss_starts", "loss_ends")]
)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_bar = re.compile(r"<(\\*)\|")
_escaped_bar = re.compile(r"<(\\*)\\\|")
_role_escape = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _bar.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _escaped_bar.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _role_escape.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The text of a conversation and the sorted spans (start, end) of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LEARNED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    out = []
    for turn in text.split(END)[:-1]:
        role, _, body = turn.removeprefix(START).partition("\n")
        out.append((unescape_role(role), unescape(body)))
    return out


def mask(offsets: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens meet a span, and the characters they share with it, adjoining ones joined."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), bool), np.zeros((0, 2), np.int64)
    # The first span that ends after the token starts; tokens are shorter than the control text between two spans.
    k = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")
    near = spans[np.minimum(k, len(spans) - 1)]
    low, high = np.maximum(offsets[:, 0], near[:, 0]), np.minimum(offsets[:, 1], near[:, 1])
    meets = (k < len(spans)) & (low < high)
    low, high = low[meets], high[meets]
    reach = np.maximum.accumulate(high)
    new = np.flatnonzero(np.concatenate([[True], low[1:] > reach[:-1]])) if len(low) else np.zeros(0, np.int64)
    return meets, np.stack([low[new], np.append(reach[new[1:] - 1], reach[-1:])], axis=1)


def _format(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path).tokenizer
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(low, 64).to_pylist():
                    text, spans = render([(t["role"], t["text"]) for t in row["turns"]])
                    coded = tokenizer.encode(text, add_special_tokens=False)
                    meets, shared = mask(np.array(coded.offsets, np.int64).reshape(-1, 2), spans)
                    out.append((row["conv_id"], text, coded.ids, meets.tolist(), shared[:, 0].tolist(), shared[:, 1].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _FORMATTED_TYPES, strict=True)], schema=_FORMATTED_TYPES
                )

    return run


def format_chats(turns: DataFrame, tokenizer: str) -> DataFrame:
    """One row for each conversation: its text, token ids, loss mask and the character spans under the mask."""
    clean = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    whole = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return whole.mapInArrow(_format(tokenizer), FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations finds: turns, text under the loss mask, and their hashes."""
    fields = pa.schema([(c.split()[0], pa.string() if "sha" in c else pa.int64()) for c in DIGESTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = parse(row["text"])
                spans = zip(row["loss_starts"], row["loss_ends"], strict=True)
                loss = "".join(unescape(row["text"][low:high]) for low, high in spans)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append(
                    (row["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), len(row["text"]))
                )
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

    return formatted.select("conv_id", "text", "loss_starts", "loss_ends").mapInArrow(run, DIGESTS)
