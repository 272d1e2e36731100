"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z only; they are compared by the SHA-256
of that form. A Misra-Gries sketch names the digests that may be frequent, an exact count verifies
them, and the verified winners, at most ``TOP`` rows, are broadcast: copies of a frequent text are settled
where they are read and never shuffled. All other digests are shuffled in the ordinary way; none of
them has more than about a ``TOP``-th of the rows.

Defined cases: null text counts as empty; equal texts keep the row with the largest doc_id, a null
doc_id being smaller than any other; of rows that also share the doc_id one stays; an empty table gives
an empty result; columns of the input never clash with columns made here. Everything is DataFrame
functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle, text_or_empty

#: Counters of the sketch, and the most digests that are taken as frequent.
TRACKED, TOP = 16384, 4096
#: The sketches of all tasks are merged by this many tasks, and their results by one.
MERGERS = 64


def digest(text: str) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    folded = F.translate(text_or_empty(text), string.ascii_uppercase, string.ascii_lowercase)
    return F.unhex(F.sha2(folded.cast("binary"), 256))


def frequent(rows: DataFrame, top: int = TOP, tracked: int = TRACKED) -> DataFrame:
    """The winner of each frequent digest, at most ``top`` rows: digest, best (id, rid), size.

    ``rows`` has digest, id, rid. A digest is frequent if more than a ``top``-th of all rows have it.
    The sketch keeps ``tracked`` counters and misses no such digest; its counts are estimates, so the
    candidates are counted exactly before any of them is used.
    """
    head = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")
    heads = rows.select(head.alias("head"))
    parts = heads.groupBy((F.spark_partition_id() % MERGERS).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(head, {tracked})").alias("sketch")
    )
    # Grouped by a constant, so that tasks without rows add no empty sketch.
    total = parts.groupBy(F.lit(1).alias("all")).agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"))
    candidates = total.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {top})")).alias("c")).select(F.col("c.item").alias("head"))
    counted = (
        rows.withColumn("head", head)
        .join(F.broadcast(candidates), "head", "left_semi")
        .groupBy("digest")
        .agg(F.max(F.struct("id", "rid")).alias("best"), F.count(F.lit(1)).alias("size"))
    )
    everything = rows.agg(F.count(F.lit(1))).scalar()
    # More than a top-th of the rows each, so there are fewer than top of them.
    return counted.where((F.col("size") * top > everything) & (F.col("size") > 1))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    rows = settle(
        docs.select(
            F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("rid")
        ),
        "digests",
    )
    winners = settle(frequent(rows), "frequent")
    split = rows.join(F.broadcast(winners), "digest", "left")
    hot = split.where(F.col("size").isNotNull())
    group = W.partitionBy("digest")
    rest = (
        split.where(F.col("size").isNull())
        .drop("best", "size")
        .withColumn("best", F.max(F.struct("id", "rid")).over(group))
        .withColumn("size", F.count(F.lit(1)).over(group))
    )
    return hot.unionByName(rest).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Each text that stays is shuffled once."""
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), digest(text_col).alias("digest"))
    rows = settle(whole.select("id", "digest", F.monotonically_increasing_id().alias("rid")), "digests")
    winners = settle(frequent(rows), "frequent").select("digest", F.col("best.id").alias("best_id"), F.lit(True).alias("hot"))
    left = whole.join(F.broadcast(winners), "digest", "left").where(F.col("hot").isNull() | F.col("id").eqNullSafe(F.col("best_id")))
    # Spark cuts each task's rows to the first of a digest before the shuffle, so repeated rows do not pile up.
    first = F.row_number().over(W.partitionBy("digest").orderBy(F.col("id").desc_nulls_last(), F.xxhash64("row")))
    return left.withColumn("n", first).where("n = 1").select("row.*")
