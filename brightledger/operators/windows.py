"""Window operators.

Series windows take frames with one row per (keys, date): a window partition then never
holds more rows than the calendar has days, however large the facts below are. ``keys=[]``
is one series; pass keys for many. ``dedup_latest`` and ``topk`` work on raw rows:
the first is an aggregate with a map-side pass, the second prunes to k rows per
task before the shuffle, so a hot key never meets in one task as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import dbl, r2, ratio, zscore

REV = "daily_revenue"


def _series(order: str | Column, keys: Sequence[str] = ()):
    # With no keys every row shares one partition; see the size bound above.
    return W.partitionBy(*keys).orderBy(order)


def topk(df: DataFrame, keys: list[str | Column], order: list[Column], k: int, rank: str = "rank_in_group") -> DataFrame:
    """First k rows per group. ``order`` must be total to be repeatable."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def dedup_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def ranks(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    w = _series(F.desc(REV), keys)
    return daily.select(
        *keys, "sale_date", dbl(REV).alias(REV),
        F.rank().over(w).alias("rank_val"), F.dense_rank().over(w).alias("dense_rank_val"),
    )


def month_ranks(daily: DataFrame) -> DataFrame:
    """Months ranked by their total."""
    months = daily.groupBy(D.month_start("sale_date").alias("month")).agg(F.sum(REV).alias("_s"))
    return months.select(
        "month", dbl("_s").alias("revenue"), F.rank().over(W.orderBy(F.desc("_s"))).alias("revenue_rank")
    )


def quartiles(daily: DataFrame, n: int = 4, keys: Sequence[str] = ()) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(REV, "sale_date")
    return daily.select(*keys, "sale_date", dbl(REV).alias(REV), F.ntile(n).over(w).alias("quartile"))


def relative_positions(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    w = _series(REV, keys)
    return daily.select(
        *keys, "sale_date", dbl(REV).alias(REV),
        F.floor(F.percent_rank().over(w) * 10000.0 + 0.5).alias("pct_rank_e4"),
        F.floor(F.cume_dist().over(w) * 10000.0 + 0.5).alias("cume_dist_e4"),
    )


def neighbours(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Previous and next row of the series and the change."""
    w = _series("sale_date", keys)
    return daily.select(
        *keys, "sale_date",
        dbl(REV).alias("today"),
        dbl(F.lag(REV, 1).over(w)).alias("yesterday"),
        dbl(F.lead(REV, 1).over(w)).alias("tomorrow"),
        dbl(F.col(REV) - F.lag(REV, 1).over(w)).alias("change_from_yesterday"),
    )


def lag_or_zero(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    prev = F.coalesce(F.lag(REV, 1).over(_series("sale_date", keys)), F.lit(0).cast("decimal(20,2)"))
    return daily.select(
        *keys, "sale_date", dbl(REV).alias(REV), dbl(prev).alias("prev_or_zero"), dbl(F.col(REV) - prev).alias("diff")
    )


def best_and_worst(daily: DataFrame) -> DataFrame:
    """First and last value of the month by revenue; the last needs the full frame."""
    w = W.partitionBy(D.month_start("sale_date")).orderBy(F.desc(REV))
    full = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return daily.select(
        "sale_date", dbl(REV).alias(REV), D.month_start("sale_date").alias("month"),
        dbl(F.first(REV).over(w)).alias("best_day_revenue"),
        dbl(F.last(REV).over(full)).alias("worst_day_revenue"),
    )


def running_in_month(daily: DataFrame, agg: Callable[[str], Column], name: str) -> DataFrame:
    """A running aggregate that restarts each month."""
    w = W.partitionBy(D.month_start("sale_date")).orderBy("sale_date").rowsBetween(W.unboundedPreceding, 0)
    return daily.select("sale_date", dbl(REV).alias(REV), dbl(agg(REV).over(w)).alias(name))


def rolling(
    df: DataFrame, value: str, order: str, rows: int, agg: str, name: str, keys: Sequence[str] = ()
) -> DataFrame:
    """SUM, AVG or MAX over the last ``rows`` rows of a series."""
    w = _series(order, keys).rowsBetween(-(rows - 1), 0)
    if agg == "avg":
        out = r2(ratio(F.sum(value).over(w), F.count(value).over(w)))
    else:
        out = dbl({"sum": F.sum, "max": F.max, "min": F.min}[agg](value).over(w))
    return df.withColumn(name, out)


def rolling_days(df: DataFrame, value: str, order: str, days: int, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """SUM over the last ``days`` calendar days and today: a RANGE frame, so gaps count."""
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    frame = f"RANGE BETWEEN INTERVAL '{days}' DAY PRECEDING AND CURRENT ROW"
    return df.withColumn(name, F.expr(f"CAST(sum({value}) OVER ({part}ORDER BY {order} {frame}) AS DOUBLE)"))


def counts_in_month(daily: DataFrame) -> DataFrame:
    """Total and running count per month."""
    whole = W.partitionBy(D.month_start("sale_date"))
    run = whole.orderBy("sale_date").rowsBetween(W.unboundedPreceding, 0)
    return daily.select(
        "sale_date", dbl(REV).alias(REV), D.month_start("sale_date").alias("month"),
        F.count(F.lit(1)).over(whole).alias("days_in_month"),
        F.count(F.lit(1)).over(run).alias("running_day_count"),
    )


def zscore_window(
    df: DataFrame, value: str, order: str, before: int = 30, after: int = 30,
    keys: Sequence[str] = (), name: str = "revenue_zscore",
) -> DataFrame:
    """|x - mean| / deviation over a centred frame, NULL where the deviation is 0."""
    w = _series(order, keys).rowsBetween(-before, after)
    mean = ratio(F.sum(value).over(w), F.count(value).over(w))
    return df.withColumn(name, zscore(value, mean, F.stddev(dbl(value)).over(w)))


def rolling_sums(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """7-row and 30-row totals over one sort."""
    w = _series("sale_date", keys)
    return daily.select(
        *keys, "sale_date", dbl(REV).alias(REV),
        dbl(F.sum(REV).over(w.rowsBetween(-6, 0))).alias("revenue_7day_rolling"),
        dbl(F.sum(REV).over(w.rowsBetween(-29, 0))).alias("revenue_30day_rolling"),
    )


def month_to_date(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    w = W.partitionBy(*keys, F.year("sale_date"), F.month("sale_date")).orderBy("sale_date")
    return daily.select(*keys, "sale_date", dbl(REV).alias(REV), dbl(F.sum(REV).over(w)).alias("revenue_month_to_date"))


def prior_year(df: DataFrame, date: str, value: str, keys: Sequence[str] = (), previous_rows: int | None = None) -> DataFrame:
    """The value of the same day one year before, and the change in percent.

    29 February looks at 28 February. ``previous_rows`` gives the row-offset reading instead.
    """
    pct = lambda prior: r2(ratio(F.col(value) - prior, prior) * 100)
    if previous_rows is not None:
        prior = F.lag(value, previous_rows).over(_series(date, keys))
        return df.withColumn("revenue_yoy_prior", dbl(prior)).withColumn("revenue_yoy_pct_change", pct(prior))
    # The day lies 365 or 366 days back, so one window holds it and at most one neighbour: the rows are read once.
    near = W.partitionBy(*keys).orderBy(F.unix_date(F.col(date).cast("date"))).rangeBetween(-366, -365)
    days = F.collect_list(F.struct(F.col(date).cast("date").alias("d"), F.col(value).alias("v"))).over(near)
    same = F.filter("_near", lambda x: x["d"] == D.add_years(date, -1))
    return (
        df.withColumn("_near", days)
        .withColumn("_prior", F.get(same, F.lit(0))["v"])
        .withColumn("revenue_yoy_prior", dbl("_prior"))
        .withColumn("revenue_yoy_pct_change", pct(F.col("_prior")))
        .drop("_near", "_prior")
    )


# --- multi-step queries over monthly totals -------------------------------------------------


def months_against_mean(daily: DataFrame, n: int) -> DataFrame:
    """Best n months beside the mean month."""
    months = daily.groupBy(D.month_start("sale_date").alias("month")).agg(F.sum(REV).alias("_s"))
    mean = months.select(F.sum("_s").cast("double") / F.count(F.lit(1))).scalar()
    return (
        months.orderBy(F.desc("_s"), "month")
        .limit(n)
        .select(
            "month", dbl("_s").alias("revenue"), r2(mean).alias("avg_revenue"),
            r2(dbl("_s") - mean).alias("diff_from_avg"),
        )
    )


def quarter_ranks(daily: DataFrame, since: str) -> DataFrame:
    """Month totals to quarters to ranks."""
    months = (
        daily.where(F.col("sale_date") >= F.lit(since).cast("date"))
        .groupBy(D.month_start("sale_date").alias("month"))
        .agg(F.sum(REV).alias("_s"))
    )
    quarters = months.groupBy(D.quarter_start("month").alias("quarter")).agg(
        F.sum("_s").alias("_q"), F.count(F.lit(1)).alias("months_in_quarter")
    )
    return quarters.select(
        "quarter", dbl("_q").alias("quarterly_revenue"), "months_in_quarter",
        F.rank().over(W.orderBy(F.desc("_q"))).alias("revenue_rank"),
    )


def day_week_overall(daily: DataFrame) -> DataFrame:
    """Each day beside its week's and the overall mean."""
    weeks = daily.groupBy(D.week_start("sale_date").alias("week_start")).agg(
        F.sum(REV).alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    overall = daily.select(r2(F.sum(REV).cast("double") / F.count(F.lit(1)))).scalar()
    return daily.join(weeks, D.week_start("sale_date") == F.col("week_start"), "left").select(
        "sale_date", dbl(REV).alias(REV), r2(ratio("_s", "_n")).alias("week_avg"), overall.alias("overall_avg"),
        r2(dbl(REV) - overall).alias("diff_from_overall"),
    )


def fill_gaps(daily: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every calendar day between two dates; days without sales get 0 and a status."""
    spine = daily.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("calendar_date"))
    return spine.join(daily, F.col("calendar_date") == F.col("sale_date"), "left").select(
        "calendar_date",
        F.coalesce(dbl(REV), F.lit(0.0)).alias("revenue"),
        F.when(F.col("sale_date").isNull(), F.lit("NO SALES")).otherwise(F.lit("HAS SALES")).alias("status"),
    )
