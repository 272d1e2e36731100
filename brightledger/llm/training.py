"""Bounded samples of labelled texts for the models, and scoring of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .tokens import ranges

#: A labelled text longer than this is passed over when a model is fitted; scoring reads all texts whole.
LONGEST = 1 << 16


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``rows`` labelled texts, up to half of them of either label: (text, 0 or 1).

    ``keep`` is a condition on the labels. The sample follows a hash of the id, so it is the same on every run; it
    bounds what the driver gets at ``rows * LONGEST`` bytes. Ids without a label, labels other than 0 and 1 and null ids are passed over.
    """
    usable = labels.where(keep).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null")
    chosen = None
    for y in (0, 1):
        # Each task sends its own first rows only. Some of these ids may have no usable text.
        part = usable.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows // 2 * 5 // 4)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).where(F.octet_length("text") <= LONGEST)
    # A bounded list of ids, so its documents are picked where they are read.
    found = texts.join(F.broadcast(chosen.dropDuplicates(["id"])), "id")
    out = []
    for r in found.orderBy(F.xxhash64("id"), "id", "text").limit(rows * 5 // 4).collect():
        if sum(y == r.y for _, y in out) < rows // 2:
            out.append((r.text, r.y))
    return out


def _scores(score: Callable[[list[str]], np.ndarray], texts: pa.Array) -> np.ndarray:
    """The score of every text of a batch, null counting as empty. Only a portion of the batch becomes Python objects at a time."""
    texts = pc.fill_null(texts, "")
    parts = [score(texts.slice(low, high - low).to_pylist()) for low, high in ranges(texts, len(texts))]
    return np.concatenate([np.zeros(0), *parts])


def scored(docs: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every whole text. ``load`` gives the scoring function in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = load()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(score, batch.column(1)), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def filtered(docs: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], least: float, text_col: str = "text") -> DataFrame:
    """The rows whose text scores at least ``least``, with all columns and without moving any."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = load()
        for batch in batches:
            yield batch.filter(pa.array(_scores(score, batch.column(at)) >= least))

    return docs.mapInArrow(run, docs.schema)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
