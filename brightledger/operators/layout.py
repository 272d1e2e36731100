"""Where the rows of a frame lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of a table, as Spark estimates them, whose words one task groups in memory.
PORTION = 2 << 20
#: From so many portions on, a size is Spark's stand-in for an unknown one.
PORTIONS = 1 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the scratch folder and read back.

    A join of two frames that are both read, not aggregated, has a plain exchange on either side, so Spark can
    split the rows of a hot key over several tasks.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A small table, dealt by its keys; a large one as it lies.

    A small table may be one row group, which one task reads while the others wait. Up to one scan split the
    rows are dealt, which moves little; beyond that the scan has several, and moving whole texts would cost more than it gives.
    """
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return df.repartition(*keys) if _estimated_bytes(df) <= conf.filesMaxPartitionBytes() else df


def portioned(df: DataFrame, *keys: str) -> DataFrame:
    """Texts dealt by their keys, a large table into portions of about ``PORTION`` estimated bytes.

    Their words, grouped by the same keys and others, need no further exchange, and those of a portion fit into a task's memory, also where a scan split or
    a partition of the advisory size would have to sort them on disk. The texts are moved once, which is less than moving their words.
    Where Spark has no estimate, its own number of partitions holds.
    """
    portions = -(-_estimated_bytes(df) // PORTION)
    sized = df.sparkSession.sparkContext.defaultParallelism < portions < PORTIONS
    return df.repartition(portions, *keys) if sized else df.repartition(*keys)


def broadcast_bytes(df: DataFrame) -> int:
    """How many bytes the session lets Spark broadcast for a join; 0 if it lets it broadcast nothing."""
    return max(0, df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def range_bounds(source: DataFrame, key: Column, parts: int) -> list[int]:
    """Bounds of ``parts`` ranges of a whole number with about as many rows of ``source`` each: one aggregate with a mergeable quantile sketch."""
    shares = [k / parts for k in range(1, parts)]
    found = source.agg(F.percentile_approx(key, shares, 10_000).alias("b")).first()["b"] if shares else []
    return sorted(set(found or []))


def clustered(df: DataFrame, key: Column, bounds: Sequence[int], *order: str) -> DataFrame:
    """The rows in ranges of ``key``, sorted within each.

    ``repartitionByRange`` runs the frame once for a sample and once for its rows. Here the bounds are known, for example from the table that the key comes from,
    so the frame runs once. A range is found by binary search; rows without a key are in the first.
    """
    if not bounds:
        return df.repartition(1).sortWithinPartitions(*order)
    # One column a step, as each is used twice in the next: all of them are compiled, which a lambda over the steps is not.
    found, n = F.array(*[F.lit(b).cast("bigint") for b in bounds]), len(bounds)
    placed = df.withColumn("_key", key.cast("bigint")).withColumn("_at", F.lit(0))
    for step in [1 << k for k in reversed(range(n.bit_length()))]:
        ahead = F.get(found, F.col("_at") + (step - 1)) <= F.col("_key")
        placed = placed.withColumn("_at", F.col("_at") + F.when(ahead, step).otherwise(0))
    return placed.drop("_key").repartitionById(n + 1, F.col("_at")).drop("_at").sortWithinPartitions(*order)
