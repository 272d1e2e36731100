"""Synthetic daily series: level, trend, month and weekday effects, and noise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import hash_uniform, r2
from ..operators.calendar import date_spine

# Effect of the months January to December on a day's revenue.
MONTH_EFFECT = (-15, -10, 0, 5, 10, 15, 12, 10, 8, 15, 30, 45)
# Effect of weekend days and of other days.
WEEKDAY_EFFECT = (-20, 10)


def daily_sales(
    spark: SparkSession,
    start: str = "2023-01-01",
    n: int = 730,
    base: float = 100.0,
    slope: float = 0.15,
    month_effect=MONTH_EFFECT,
    weekday_effect=WEEKDAY_EFFECT,
    noise: float = 15.0,
    keys: DataFrame | None = None,
) -> DataFrame:
    """n days of revenue and orders, once or per row of ``keys``.

    The noise is a hash of key and date, so a rerun on any layout gives the same rows. The
    last date is start + n - 1: 730 rows from 2023-01-01 end on 2024-12-30.
    """
    names = [] if keys is None else keys.columns
    days = date_spine(spark, start, n, keys)
    months = F.array(*[F.lit(float(x)) for x in month_effect])
    weekend, weekday = (F.lit(float(x)) for x in weekday_effect)
    seed = F.concat_ws("|", *names, "sale_date")
    t = F.datediff("sale_date", F.lit(start).cast("date"))
    trend = F.lit(base) + t * F.lit(slope)
    season = F.element_at(months, F.month("sale_date"))
    day = F.when(D.is_weekend("sale_date"), weekend).otherwise(weekday)
    value = trend + season + day + hash_uniform(F.concat(seed, F.lit("|n")), -noise, noise)
    per_order = hash_uniform(F.concat(seed, F.lit("|o")), 15.0, 35.0)
    return days.select(
        *names,
        "sale_date",
        r2(F.greatest(value, F.lit(10.0))).alias("daily_revenue"),
        F.floor(F.greatest(value / per_order, F.lit(1.0)) + 0.5).cast("int").alias("num_orders"),
    )
