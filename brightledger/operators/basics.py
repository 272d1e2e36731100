"""Projections, filters, sorts and unions over a daily sales frame (sale_date, daily_revenue, num_orders).

Frames at the day grain hold one row per calendar day, so a global sort of them stays small
whatever the size of the orders below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import dbl, ratio, r2, tier

# Tiers of a day by its revenue as a multiple of the mean day.
TIERS = [(1.25, "HIGH"), (1.0, "MEDIUM"), (0.75, "LOW")]
OTHER_TIER = "VERY LOW"


def revenue_tier(revenue: Column | str, bounds=None, otherwise: str = OTHER_TIER) -> Column:
    return tier(revenue, bounds or TIERS, otherwise)


def top_days(daily: DataFrame, min_revenue, since: str, n: int) -> DataFrame:
    """The n best days above a revenue and after a date; the date breaks ties."""
    return (
        daily.where((dbl("daily_revenue") > F.lit(min_revenue)) & (F.col("sale_date") >= F.lit(since).cast("date")))
        .orderBy(F.desc("daily_revenue"), "sale_date")
        .limit(n)
        .select("sale_date", dbl("daily_revenue").alias("daily_revenue"), "num_orders")
    )


def revenue_per_order(daily: DataFrame, since: str, keep_share: float = 0.9) -> DataFrame:
    """Computed columns with a guarded division."""
    return daily.where(F.col("sale_date") >= F.lit(since).cast("date")).select(
        "sale_date",
        dbl("daily_revenue").alias("daily_revenue"),
        "num_orders",
        r2(ratio("daily_revenue", "num_orders")).alias("revenue_per_order"),
        (dbl("daily_revenue") * F.lit(keep_share)).alias("revenue_after_tax"),
    )


def distinct_months(daily: DataFrame) -> DataFrame:
    return daily.select(D.month_start("sale_date").alias("month")).distinct()


def either_and(daily: DataFrame, min_revenue, min_orders: int, since: str) -> DataFrame:
    """(revenue above x OR orders above y) AND date from d."""
    strong = (dbl("daily_revenue") > F.lit(min_revenue)) | (F.col("num_orders") > min_orders)
    return _plain(daily.where(strong & (F.col("sale_date") >= F.lit(since).cast("date"))))


def on_weekdays(daily: DataFrame, names: list[str], first: str, last: str, negate: bool = False) -> DataFrame:
    """Days whose short English name is (or is not) in a list, within two dates."""
    named = F.dayname("sale_date").isin(*names)
    span = F.col("sale_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return _plain(daily.where((~named if negate else named) & span))


def month_like(daily: DataFrame, pattern: str) -> DataFrame:
    """Days whose 'yyyy-MM' text matches a LIKE pattern."""
    return _plain(daily.where(F.date_format("sale_date", "yyyy-MM").like(pattern)))


def revenue_between(daily: DataFrame, low, high, since: str) -> DataFrame:
    in_range = dbl("daily_revenue").between(F.lit(low), F.lit(high))
    return _plain(daily.where(in_range & (F.col("sale_date") >= F.lit(since).cast("date"))))


def not_null(df: DataFrame, column: str, negate: bool = False) -> DataFrame:
    return df.where(F.col(column).isNull() if negate else F.col(column).isNotNull())


def buckets(daily: DataFrame, value: str = "revenue_index", bounds=None) -> DataFrame:
    """Searched CASE for the tier and simple CASE for the season."""
    month = F.month("sale_date")
    season = (
        F.when(month.isin(12, 1, 2), F.lit("WINTER"))
        .when(month.isin(3, 4, 5), F.lit("SPRING"))
        .when(month.isin(6, 7, 8), F.lit("SUMMER"))
        .otherwise(F.lit("AUTUMN"))
    )
    return daily.select(
        "sale_date", revenue_tier(value, bounds).alias("revenue_tier"), season.alias("season")
    )


def casts(daily: DataFrame) -> DataFrame:
    """Explicit casts and typed NULL columns; a float is rounded before it becomes an integer."""
    return daily.select(
        F.col("sale_date").cast("string").alias("date_text"),
        F.floor(dbl("daily_revenue") + F.lit(0.5)).cast("bigint").alias("revenue_int"),
        F.col("num_orders").cast("int").alias("orders_int"),
        F.lit(None).cast("double").alias("forecast_revenue"),
        F.lit(None).cast("date").alias("forecast_date"),
        F.col("sale_date").cast("string").cast("date").alias("sale_date"),
    )


def with_default(df: DataFrame, column: str, default) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def against_mean(daily: DataFrame) -> DataFrame:
    """Each day beside the overall mean, read as a scalar subquery."""
    mean = daily.select(F.sum("daily_revenue").cast("double") / F.count(F.lit(1))).scalar()
    return daily.select(
        "sale_date",
        dbl("daily_revenue").alias("daily_revenue"),
        r2(mean).alias("avg_revenue"),
        F.when(dbl("daily_revenue") > mean, F.lit("ABOVE")).otherwise(F.lit("BELOW")).alias("position"),
    )


def sorted_by_month(daily: DataFrame, since: str, n: int) -> DataFrame:
    """First n rows by month up, revenue down."""
    month = D.month_start("sale_date")
    return (
        daily.where(F.col("sale_date") >= F.lit(since).cast("date"))
        .select(month.alias("month"), "sale_date", "daily_revenue")
        .orderBy(F.asc("month"), F.desc("daily_revenue"), F.asc("sale_date"))
        .limit(n)
        .select("month", "sale_date", dbl("daily_revenue").alias("daily_revenue"))
    )


def sorted_by_position(daily: DataFrame, n: int) -> DataFrame:
    """ORDER BY ordinals."""
    sql = "SELECT sale_date, daily_revenue, num_orders FROM {d} ORDER BY 2 DESC, 1 LIMIT {n}"
    return _plain(daily.sparkSession.sql(sql, d=daily, n=n))


def sorted_nulls_last(df: DataFrame, value: str, tie: str, n: int | None = None) -> DataFrame:
    """Rows by value down with NULL after every value; only the first n where given."""
    out = df.orderBy(F.desc_nulls_last(value), F.asc(tie))
    return out if n is None else out.limit(n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any n rows, in no stated order."""
    return df.limit(n)


def period_totals(daily: DataFrame, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """One labelled total per period; all periods in a single conditional pass."""
    expr = None
    for label, (first, last) in periods.items():
        cond = F.col("sale_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return (
        daily.select(expr.alias("period"), "daily_revenue")
        .where(F.col("period").isNotNull())
        .groupBy("period")
        .agg(dbl(F.sum("daily_revenue")).alias("total_revenue"))
    )


def _plain(daily: DataFrame) -> DataFrame:
    return daily.select("sale_date", dbl("daily_revenue").alias("daily_revenue"), "num_orders")
