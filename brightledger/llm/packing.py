"""Packing by powers of two.

A document's ids, with the end id, are cut into pieces whose lengths are powers of two: as many of the longest
as fit, then the binary digits of what is left, from high to low. Every piece is a sequence by itself, kept with
the sequences of the same length, so no sequence crosses documents and none needs padding; training takes
batches from one length at a time.

``pack`` writes the sequences below the shared folder, in one directory for each length, and returns what it wrote. A sequence number holds
the shard (the task that made it) above ``SHARD_BITS`` and the place in the shard below, so numbering needs no shuffle. Defined cases: null text counts as empty and gives one piece with
the end id; a null or repeated doc_id is kept as it is, each row being a document of its own; an empty table
gives no pieces; a text of any length gives as many of the longest pieces as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir
from .common import text_or_empty
from .tokens import encoder, portions

LONGEST = 2048

SHARD_BITS = 33

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_TYPES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """The lengths of the pieces of n ids."""
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length())) if n % longest >> b & 1]


def _cut(path: str, end_id: int, longest: int, memo: int | None):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, number = encoder(path, memo=memo), TaskContext.get().partitionId() << SHARD_BITS
        for batch in batches:
            for ids, texts in portions(batch, 256):
                out = []
                for doc_id, data in zip(ids, enc.encode(texts), strict=True):
                    data += end
                    n, at = len(data) // 4, 0
                    for size in lengths(n, longest):
                        out.append((doc_id, at, size, n, number, 0, data[4 * at : 4 * (at + size)]))
                        number += 1
                        at += size
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], schema=_TYPES)

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text", memo: int | None = None) -> DataFrame:
    """The pieces: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian, 32 bits each).

    ``memo``: how many pieces of text a worker keeps the ids of; fewer take less memory and more time, and give the same ids.
    """
    if longest < 1 or longest & longest - 1:
        raise ValueError("longest must be a power of two")
    spark = docs.sparkSession
    shared_dir(spark)
    path = scratch_path(spark, "packed")
    (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
        .mapInArrow(_cut(tokenizer, end_id, longest, memo), PIECES)
        .write.partitionBy("length")
        .option("compression", "zstd")
        .parquet(path)
    )
    return spark.read.schema(PIECES).parquet(path)


def checked(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in the place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
