"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_dir

# monotonically_increasing_id holds the partition above these bits and the row within it below.
_ROW_BITS = 33


def hash_key(*natural: str) -> Column:
    """A 64-bit key from the natural key: no order, no shuffle, the same on every run."""
    return F.xxhash64(*natural)


def dense_numbers(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """1, 2, 3 ... in the order of columns that together are unique, without sorting everything in one task.

    Rows are range-partitioned and sorted, then numbered within their partition; the sizes of the
    partitions before are added. The numbered rows are checkpointed, so that both
    steps see the same partitions even when an executor is lost. Runs a job.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    )
    placed = placed.withColumn("_part", F.shiftright("_id", _ROW_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition: safe to broadcast at any size of the data.
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_offset") + row + 1).alias(name))
