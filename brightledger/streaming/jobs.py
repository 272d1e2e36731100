"""Streaming jobs.

Every job reads only new files, keeps its place in a checkpoint, and writes each micro-batch under
the batch's number. A batch that runs again after a failure replaces what it wrote, so results count every row once. Rows are
counted while the batch is written, so it is read once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions.numbers import cents, dbl, money, r2, ratio
from ..operators.changes import incremental_sum, labelled
from ..sources.parts import PartTable
from ..sources.readers import read_or_empty


def follow(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, **options) -> DataFrame:
    """A stream over the Parquet files of a folder, old and new."""
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> int:
    """Process what has arrived since the last run, then stop. Returns the rows of all batches; without new data no batch runs."""
    rows: dict[int, int] = {}

    def counted(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        on_batch(batch.observe(seen, F.count(F.lit(1)).alias("rows")), batch_id)
        rows[batch_id] = seen.get["rows"] if _has_ended(seen) else batch.count()

    _run(stream, checkpoint, counted)
    return sum(rows.values())


def _has_ended(seen: Observation, wait: float = 0.2) -> bool:
    """Whether the job has read its batch to the end, so that its rows are counted. The count follows the job by a moment."""
    end = time.monotonic() + wait
    while not (ended := seen._jo.future().isCompleted()) and time.monotonic() < end:
        time.sleep(0.01)
    return ended


def _run(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> None:
    q = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def run_if_data(stream: DataFrame, checkpoint: str, job: Callable[[DataFrame, int], None]) -> bool:
    """Run a job for the batches that have rows, and say whether there was one. A batch of empty files is passed over; its first row is looked for, no more."""
    ran = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            job(batch, batch_id)
            ran.append(batch_id)

    _run(stream, checkpoint, on_batch)
    return bool(ran)


def consume(stream: DataFrame, log_path: str, checkpoint: str) -> int:
    """Consume change rows once into a log with INSERT, UPDATE or DELETE and the time of capture."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = labelled(batch).drop("action", "is_update").withColumn("captured_at", F.current_timestamp())
        rows.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    return run_available(stream, checkpoint, write)


def hourly_rollup(stream: DataFrame, ts: str, out_path: str, checkpoint: str) -> int:
    """Rows per hour of each batch. Counts add up across batches, so late rows count and no state is kept."""

    def write(batch: DataFrame, batch_id: int) -> None:
        hours = batch.groupBy(D.trunc_wall(ts, "hour").alias("hour"))
        hours.agg(F.count(F.lit(1)).alias("new_rows")).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return run_available(stream, checkpoint, write)


def read_rollup(spark: SparkSession, out_path: str) -> DataFrame:
    """Rows per hour so far; no rows before the first batch."""
    rows = read_or_empty(spark, out_path, "hour timestamp_ntz, new_rows bigint")
    return rows.groupBy("hour").agg(F.sum("new_rows").alias("new_rows"))


def windowed_rollup(stream: DataFrame, ts: str, out_path: str, checkpoint: str, late: str = "1 hour", window: str = "1 hour") -> int:
    """Rows per event-time window, kept in Spark's state store below the checkpoint. Returns how many counts were written.

    A row counts in the window of its own time, in whichever batch it comes, until the watermark has passed the end of that window: the newest time seen in
    earlier batches less ``late``. Rows that come later than that are left out, and their window's state is gone by then, so the state holds the windows of that
    span only. Each batch writes the windows that it changed with their whole counts, so a batch that runs again changes nothing. Times without a zone
    are read as UTC.
    """
    at = F.col(ts)
    if dict(stream.dtypes)[ts] == "timestamp_ntz":
        at = F.to_timestamp_ltz(F.concat(at.cast("string"), F.lit("Z")))
    counts = stream.select(at.alias("_at")).withWatermark("_at", late).groupBy(F.window("_at", window)).agg(F.count(F.lit(1)).alias("new_rows"))
    written = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal written
        seen = Observation()
        start = F.to_timestamp_ntz(F.date_format(F.to_utc_timestamp("window.start", F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        batch.observe(seen, F.count(F.lit(1)).alias("rows")).select(start.alias("hour"), "new_rows").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        written += seen.get["rows"]

    q = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return written


def read_windows(spark: SparkSession, out_path: str) -> DataFrame:
    """Rows per window as of the last batch that changed it."""
    rows = read_or_empty(spark, out_path, "hour timestamp_ntz, new_rows bigint, batch_id bigint")
    return rows.groupBy("hour").agg(F.max_by("new_rows", "batch_id").alias("new_rows"))


class RevenueSummaries:
    """Monthly, quarterly and yearly summaries kept up to date from new orders.

    A batch recomputes only the months it touches, from stored day sums; then only the quarters
    of those months, and the years of those quarters. Each level is a table in parts (days by quarter, all others by year), of which a batch reads and
    rewrites those it touches, under its own number. The lists of touched periods are bounded by the calendar. The present and the former rows of a part are kept, so a batch that
    fails can run again; older ones are deleted, so neither the files nor the bytes read grow with the number of batches.
    """

    DAYS = "sale_date date, revenue_cents bigint, num_orders bigint, month date, quarter date"
    MONTHS = "month date, total_cents bigint, total_orders bigint, days bigint, best_cents bigint, quarter date, year int"
    QUARTERS = "quarter date, total_cents bigint, total_orders bigint, year int"
    YEARS = "year int, total_cents bigint, total_orders bigint, of_year int"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        table = lambda level, ddl, part: PartTable(spark, f"{self.path}/{level}", ddl, part)
        self.days, self.months = table("days", self.DAYS, "quarter"), table("months", self.MONTHS, "year")
        self.quarters, self.years = table("quarters", self.QUARTERS, "year"), table("years", self.YEARS, "of_year")

    def refresh(self, stream: DataFrame, date: str, amount: str) -> int:
        """Take in the new orders. Returns the rows read."""

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            self._refresh_batch(batch, batch_id, date, amount)

        return run_available(stream, f"{self.path}/checkpoint", on_batch)

    def _refresh_batch(self, batch: DataFrame, batch_id: int, date: str, amount: str) -> None:
        day = F.col(date).cast("date")
        new = batch.groupBy(day.alias("sale_date")).agg(
            F.sum(cents(amount)).alias("revenue_cents"), F.count(F.lit(1)).alias("num_orders")
        ).withColumn("month", D.month_start("sale_date"))
        # A row for each day; the part of no month holds orders without a date, which no summary has.
        path = f"{self.path}/incoming/batch_id={batch_id}"
        new.where("sale_date is not null").coalesce(1).write.mode("overwrite").parquet(path)
        new = self.spark.read.parquet(path)
        months = [r.month for r in new.select("month").distinct().collect()]
        if not months:
            return
        quarters = sorted({m.replace(month=(m.month - 1) // 3 * 3 + 1) for m in months})
        years = sorted({m.year for m in months})

        sums, of = ["revenue_cents", "num_orders"], F.col("month").isin(months)
        new = new.withColumn("quarter", D.quarter_start("month"))
        self.days.change(quarters, lambda old: incremental_sum(new, old, ["sale_date", "month", "quarter"], sums), batch_id)

        fresh = self.days.read(quarters).where(of).groupBy("month").agg(
            F.sum("revenue_cents").alias("total_cents"),
            F.sum("num_orders").alias("total_orders"),
            F.count(F.lit(1)).alias("days"),
            F.max("revenue_cents").alias("best_cents"),
        ).withColumns({"quarter": D.quarter_start("month"), "year": F.year("month")})
        self.months.change(years, lambda old: old.where(~of).unionByName(fresh), batch_id)

        def total(rows: DataFrame, period: str) -> DataFrame:
            return rows.groupBy(period).agg(F.sum("total_cents").alias("total_cents"), F.sum("total_orders").alias("total_orders"))

        of_quarters = F.col("quarter").isin(quarters)
        changed = total(self.months.read(years).where(of_quarters), "quarter").withColumn("year", F.year("quarter"))
        self.quarters.change(years, lambda old: old.where(~of_quarters).unionByName(changed), batch_id)
        self.years.replace(total(self.quarters.read(years), "year").withColumn("of_year", F.col("year")), years, batch_id)
        for level in (self.days, self.months, self.quarters, self.years):
            level.clean()

    def monthly(self) -> DataFrame:
        return self.months.read().select(
            "month",
            dbl(money("total_cents")).alias("total_revenue"),
            "total_orders",
            r2(ratio(money("total_cents"), "days")).alias("avg_daily"),
            dbl(money("best_cents")).alias("best_day"),
        )

    def quarterly(self) -> DataFrame:
        return self.quarters.read().select(
            "quarter",
            dbl(money("total_cents")).alias("quarterly_revenue"),
            F.col("total_orders").alias("quarterly_orders"),
            r2(ratio(money("total_cents"), "total_orders")).alias("revenue_per_order"),
        )

    def yearly(self) -> DataFrame:
        return self.years.read().select(
            "year",
            dbl(money("total_cents")).alias("annual_revenue"),
            F.col("total_orders").alias("annual_orders"),
        )
