"""Append-only log of loads and refreshes."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import read_or_empty

LOG = (
    "load_id string, layer string, table_name string, row_count bigint, execution_time double, "
    "status string, error_message string, load_timestamp timestamp"
)


class PipelineLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def add(self, layer: str, table: str, rows: int | None, seconds: float, status: str, error: str | None = None) -> None:
        entry = self.spark.range(1).select(
            F.lit(uuid.uuid4().hex).alias("load_id"),
            F.lit(layer).alias("layer"),
            F.lit(table).alias("table_name"),
            F.lit(rows).cast("bigint").alias("row_count"),
            F.lit(seconds).cast("double").alias("execution_time"),
            F.lit(status).alias("status"),
            F.lit(error).cast("string").alias("error_message"),
            F.current_timestamp().alias("load_timestamp"),
        )
        entry.coalesce(1).write.mode("append").parquet(self.path)

    def run(self, layer: str, table: str, job: Callable[[], int]) -> int:
        """Run a job that returns its row count; log success or failure, and pass a failure on."""
        start = time.monotonic()
        try:
            rows = job()
        except Exception as e:
            self.add(layer, table, None, time.monotonic() - start, "FAILED", f"{type(e).__name__}: {e}")
            raise
        self.add(layer, table, rows, time.monotonic() - start, "SUCCESS")
        return rows

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, LOG)

    def newest(self, n: int = 10) -> DataFrame:
        return self.read().orderBy(F.desc("load_timestamp"), "load_id").limit(n)
