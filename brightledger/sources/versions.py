"""Versioned Parquet tables: each write is a new folder, and a small log names the current one.

Plain Parquet tables refuse UPDATE, DELETE and overwriting a table from itself. Here a change writes
``v=<n>`` and then one row to the log; readers follow the log, so a failed or repeated write
is never seen half done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import read_or_empty

LOG = "version int, action string, committed_at timestamp"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def history(self) -> DataFrame:
        """The log: one row per committed version."""
        return read_or_empty(self.spark, f"{self.path}/log", LOG)

    def version(self) -> int:
        """Current version, 0 before the first write. Runs a job over the log."""
        return self.history().agg(F.max("version")).first()[0] or 0

    def read(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        if v == 0:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/v={v}")

    def write(self, df: DataFrame, action: str = "WRITE", partition_by: list[str] | None = None) -> int:
        """Write a frame (which may read this table) as the next version and make it current."""
        v = self.version() + 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/v={v}")
        row = self.spark.range(1).select(
            F.lit(v).alias("version"), F.lit(action).alias("action"), F.current_timestamp().alias("committed_at")
        )
        row.write.mode("append").parquet(f"{self.path}/log")
        return v

    def truncate(self) -> int:
        """An empty version with the same columns; the rows of earlier versions stay readable."""
        return self.write(self.read().limit(0), "TRUNCATE")

    def refresh(self, df: DataFrame) -> int:
        """Full refresh: replace all rows."""
        return self.write(df, "REFRESH")
