"""CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unload_csv(df: DataFrame, path: str, header: bool = True, max_file_bytes: int | None = None) -> None:
    """Write a frame as CSV files, replacing the folder.

    A size cap becomes a row cap per file by the mean width of a row, found with one aggregate.
    """
    writer = df.write.mode("overwrite").option("header", str(header).lower()).option("escape", '"')
    if max_file_bytes is not None:
        width = F.length(F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in df.columns])) + 1
        mean = df.agg(F.avg(width)).first()[0]
        if mean:
            writer = writer.option("maxRecordsPerFile", max(1, int(max_file_bytes / mean)))
    writer.csv(path)


def export_forecast(forecast: DataFrame, path: str, days: int) -> None:
    """The first ``days`` days of a forecast table as CSV, in date order across and within files."""
    first = forecast.select(F.min("forecast_date")).scalar()
    rows = forecast.where(F.col("forecast_date") < F.date_add(first, days))
    rows = rows.select(
        "forecast_date", "forecasted_revenue", "lower_bound_95pct", "upper_bound_95pct", "confidence_interval_width"
    )
    ordered = rows.repartitionByRange("forecast_date").sortWithinPartitions("forecast_date")
    ordered.write.mode("overwrite").option("header", "true").csv(path)
