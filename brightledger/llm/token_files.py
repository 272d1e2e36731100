"""Token ids in files of compressed byte planes, and the way back.

A shard holds the ids of a range of documents in ascending order of doc_id, one after the other. Its ids are cut
into blocks of ``BLOCK``; a block is transposed into four byte planes (all lowest bytes, then all second bytes, and so
on), and each plane is compressed with zstandard by itself: the high planes of small ids are nearly free.

Files: Parquet, written by Spark's committer, so a lost task leaves nothing behind and any store will do.
One row is one block with its entry of the chunk index:

=============  =============================================================================
shard, block   the number of the shard and of the block in it
first, n_ids   the position of the block's first id in the shard, and its number of ids
planes         four zstandard frames
doc_no         how many documents of the shard start before this block
carry          ids at the front that belong to a document that starts in an earlier block
doc_ids,       of each document that starts in this block: its id and the position of its
doc_starts     first id in the shard
=============  =============================================================================

Defined cases: null text counts as empty, so the document has only its end id; a null doc_id comes before all
others; rows that share a doc_id stay separate, in order of their text; an empty table gives no blocks; a text of
any length spreads over as many blocks as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir
from .common import text_or_empty
from .tokens import encoder, portions

BLOCK = 1 << 16
PLANES = 4

CHUNKS = (
    "shard long, block long, first long, n_ids long, planes array<binary>, doc_no long, carry long, "
    "doc_ids array<long>, doc_starts array<long>"
)
_CHUNK_TYPES = pa.schema(
    [(c, pa.int64()) for c in ("shard", "block", "first", "n_ids")]
    + [("planes", pa.list_(pa.binary()))]
    + [(c, pa.int64()) for c in ("doc_no", "carry")]
    + [(c, pa.list_(pa.int64())) for c in ("doc_ids", "doc_starts")]
)
PIECES = "shard long, doc_no long, doc_id long, start long, position long, length long, crc long"
_PIECE_TYPES = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
DOCS = "shard long, doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, level: int = 3) -> list[bytes]:
    """The compressed byte planes of unsigned 32-bit ids."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=level).compress
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, PLANES).T)
    return [compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes]) -> np.ndarray:
    """The ids again."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    flat = np.stack([np.frombuffer(unpack(p), np.uint8) for p in planes])
    return np.ascontiguousarray(flat.T).view("<u4").reshape(-1)


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo that of crc32, bits in its order (the highest bit is the constant)."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc32_joined(first: int, second: int, length: int) -> int:
    """crc32 of A + B from those of A and of B and the number of bytes of B."""
    power, square = 1 << 31, 1 << 30  # 1 and x
    n = 8 * length
    while n:
        if n & 1:
            power = _times(power, square)
        square = _times(square, square)
        n >>= 1
    return _times(power, first) ^ second


def _blocks(path: str, end_id: int, block: int):
    """A task's documents, in order, to rows of CHUNKS."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(path), TaskContext.get().partitionId()
        held, size, total, docs, done = [], 0, 0, [], 0  # done: ids already in blocks
        number, begun = 0, 0  # of the next block; documents that start before it
        full = block * PLANES

        def cut(data: bytes) -> pa.RecordBatch:
            nonlocal number, begun, done, docs
            n = len(data) // PLANES
            own = [d for d in docs if d[1] < done + n]
            docs = docs[len(own) :]
            row = [
                shard, number, done, n, to_planes(np.frombuffer(data, "<u4")), begun, (own[0][1] - done) if own else n,
                [d[0] for d in own], [d[1] for d in own],
            ]
            number, begun, done = number + 1, begun + len(own), done + n
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK_TYPES, strict=True)], schema=_CHUNK_TYPES)

        for batch in batches:
            for ids, texts in portions(batch, 64):
                for doc_id, data in zip(ids, enc.encode(texts), strict=True):
                    docs.append((doc_id, total))
                    total += len(data) // PLANES + 1
                    held += [data, end]
                    size += len(data) + PLANES
                if size >= full:
                    data = b"".join(held)
                    low_byte = 0
                    while len(data) - low_byte >= full:
                        yield cut(data[low_byte : low_byte + full])
                        low_byte += full
                    held, size = [data[low_byte:]], len(data) - low_byte
        if size:
            yield cut(b"".join(held))

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> None:
    """Encode every whole text, add ``end_id`` to each, and write the blocks in ascending order of doc_id."""
    (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_blocks(tokenizer, end_id, block), CHUNKS)
        .write.parquet(path)
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to one row for each document and block, with the checksum of its ids there."""
    import zlib

    for batch in batches:
        for row in batch.to_pylist():
            data = memoryview(from_planes(row["planes"])).cast("B")
            first, n, carried = row["first"], row["n_ids"], bool(row["carry"])
            starts, ids = [None] * carried + row["doc_starts"], [None] * carried + row["doc_ids"]
            at = np.array([first] * carried + row["doc_starts"] + [first + n], np.int64)
            number = row["doc_no"] - carried
            edges = (PLANES * (at - first)).tolist()
            crc = [zlib.crc32(data[a:b]) for a, b in zip(edges, edges[1:])]
            size = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, row["shard"])), pa.array(np.arange(number, number + size)), pa.array(ids, pa.int64()),
                    pa.array(starts, pa.int64()), pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64()),
                ],
                schema=_PIECE_TYPES,
            )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The checksum of each document from those of its pieces, in order."""
    for batch in batches:
        out = []
        for pieces in batch.column("parts").to_pylist():
            total = pieces[0]["crc"]
            for p in pieces[1:]:
                total = crc32_joined(total, p["crc"], PLANES * p["length"])
            out.append(total)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("shard", "doc_id", "start", "n_tokens")), pa.array(out, pa.int64())], names=[c.split()[0] for c in DOCS.split(", ")])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents in files written by ``write``: doc_id, start over all shards, n_tokens, ids_crc32. No ids leave their block."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    docs = (
        chunks.mapInArrow(_pieces, PIECES)
        .groupBy("shard", "doc_no")
        .agg(
            F.max("doc_id").alias("doc_id"), F.max("start").alias("start"), F.sum("length").alias("n_tokens"),
            F.sort_array(F.collect_list(F.struct("position", "length", "crc"))).alias("parts"),
        )
        .mapInArrow(_checksums, DOCS)
    )
    # One row for each shard.
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return docs.join(offsets, "shard").select("doc_id", (F.col("offset") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def ids_of(spark: SparkSession, path: str) -> DataFrame:
    """The ids themselves: shard, block, first, ids as array<long>, one row for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(
                    [{"shard": row["shard"], "block": row["block"], "first": row["first"], "ids": from_planes(row["planes"]).tolist()}],
                    pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("ids", pa.list_(pa.int64()))]),
                )

    return spark.read.schema(CHUNKS).parquet(path).mapInArrow(run, "shard long, block long, first long, ids array<long>")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the files below the shared folder and read them back."""
    shared_dir(docs.sparkSession)
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)
