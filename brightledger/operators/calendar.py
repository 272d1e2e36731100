"""Date and time projections, the date spine and the date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D


def date_core(df: DataFrame, d: str) -> DataFrame:
    return df.select(
        F.col(d).alias("d"),
        F.date_add(d, 30).alias("plus_30_days"),
        F.add_months(d, -3).alias("minus_3_months"),
        D.month_start(d).alias("start_of_month"),
        F.dayname(d).alias("day_name"),
        F.quarter(d).alias("quarter"),
        F.last_day(d).alias("end_of_month"),
    )


def date_add_units(df: DataFrame, ts: str) -> DataFrame:
    d = F.col(ts).cast("date")
    return df.select(
        F.col(ts).alias("ts"),
        (F.col(ts) + F.expr("INTERVAL '12' HOUR")).alias("plus_12_hours"),
        D.add_weeks(d, 2).alias("plus_2_weeks"),
        D.add_years(d, -1).alias("one_year_ago"),
    )


def date_diff_units(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(
        a, b,
        D.diff_days(a, b).alias("diff_days"),
        D.diff_weeks(a, b).alias("diff_weeks"),
        D.diff_months(a, b).alias("diff_months"),
        D.diff_years(a, b).alias("diff_years"),
    )


def ts_diff_units(df: DataFrame, id: str, ts: str, since: str) -> DataFrame:
    start = F.lit(since).cast("timestamp_ntz")
    return df.select(id, D.diff_hours(start, ts).alias("hours"), D.diff_minutes(start, ts).alias("minutes"))


def date_trunc_units(df: DataFrame, id: str, ts: str) -> DataFrame:
    """Truncate to every unit; whole-day units come back as dates."""
    d = F.col(ts).cast("date")
    return df.select(
        id,
        *[D.trunc_wall(ts, u).alias(f"trunc_{u}") for u in ("second", "minute", "hour", "day")],
        D.week_start(d).alias("trunc_week"),
        D.month_start(d).alias("trunc_month"),
        D.quarter_start(d).alias("trunc_quarter"),
        D.year_start(d).alias("trunc_year"),
    )


def date_extract(df: DataFrame, id: str, ts: str) -> DataFrame:
    return df.select(
        id,
        F.year(ts).alias("yr"),
        F.month(ts).alias("mo"),
        F.dayofmonth(ts).alias("dy"),
        F.hour(ts).alias("hr"),
        D.dow0(ts).alias("day_of_week"),
        F.dayofyear(ts).alias("day_of_year"),
        F.weekofyear(ts).alias("week_number"),
        F.quarter(ts).alias("quarter"),
    )


def date_parts_parse_format(df: DataFrame, id: str, ts: str) -> DataFrame:
    """Build from parts, parse by pattern, format by pattern."""
    d = F.col(ts).cast("date")
    text = F.date_format(d, "dd/MM/yyyy")
    # A timestamp without zone prints its wall clock, whatever the session zone is.
    stamp = F.left(F.col(ts).cast("string"), F.lit(19))
    return df.select(
        id,
        F.make_date(F.year(d), F.month(d), F.dayofmonth(d)).alias("built_date"),
        F.expr(
            f"make_timestamp_ntz(year({ts}), month({ts}), day({ts}), hour({ts}), minute({ts}), 0)"
        ).alias("built_ts"),
        F.to_date(text, "dd/MM/yyyy").alias("parsed_date"),
        F.to_timestamp_ntz(stamp, F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed_ts"),
        F.date_format(d, "MMM dd, yyyy").alias("formatted_1"),
        F.date_format(d, "yyyy/MM/dd").alias("formatted_2"),
        F.right(stamp, F.lit(8)).alias("time_only"),
    )


def date_helpers(df: DataFrame, id: str, d: str) -> DataFrame:
    return df.select(
        id,
        F.dayname(d).alias("day_name"),
        D.dow0(d).alias("dow_num"),
        F.dayofmonth(d).alias("dom"),
        F.dayofyear(d).alias("doy"),
        F.monthname(d).alias("month_name"),
        F.weekofyear(d).alias("week_num"),
        F.last_day(d).alias("end_of_month"),
        D.week_end(d).alias("end_of_week"),
        D.year_end(d).alias("end_of_year"),
    )


def zones(df: DataFrame, id: str, ts: str, targets: dict[str, str], source: str = "UTC") -> DataFrame:
    return df.select(id, *[D.convert_zone(ts, source, z).alias(name) for name, z in targets.items()])


def ages(df: DataFrame, d: str, as_of: str) -> DataFrame:
    """Age in days, weeks and months at a given date, and its bucket."""
    today = F.lit(as_of).cast("date")
    return df.select(
        d,
        D.diff_days(d, today).alias("days_ago"),
        D.diff_weeks(d, today).alias("weeks_ago"),
        D.diff_months(d, today).alias("months_ago"),
        D.age_bucket(d, today).alias("age_bucket"),
    )


def integer_keys(df: DataFrame, d: str) -> DataFrame:
    return df.select(
        d,
        D.date_key(d).alias("date_key"),
        D.month_key(d).alias("month_key"),
        D.quarter_key(d).alias("quarter_key"),
        D.date_from_key(D.date_key(d)).alias("back"),
    )


def date_spine(spark: SparkSession, start, n, keys: DataFrame | None = None, name: str = "sale_date") -> DataFrame:
    """n consecutive days from ``start``, once or for every row of ``keys``.

    ``start`` and ``n`` may be columns of ``keys``, for spines of different length per key.
    """
    start = F.lit(start).cast("date") if isinstance(start, str) else start
    n = F.lit(n) if isinstance(n, int) else n
    base = keys if keys is not None else spark.range(1).select()
    days = F.explode(F.sequence(start, F.date_add(start, n - 1)))
    return base.where(n >= 1).withColumn(name, days)


def dim_date(spark: SparkSession, start: str, end: str, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar dimension from one date to another; ``holidays`` has one date column."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return describe_days(date_spine(spark, first, F.datediff(last, first) + 1, name="date"), "date", holidays)


def describe_days(days: DataFrame, d: str = "date", holidays: DataFrame | None = None) -> DataFrame:
    """Calendar columns for a column of distinct days."""
    out = days.select(
        D.date_key(d).alias("date_id"),
        F.col(d).alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        D.dow0(d).alias("day_of_week"),
        D.iso_dow(d).alias("iso_day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayname(d).alias("day_name"),
        F.monthname(d).alias("month_name"),
        (~D.is_weekend(d)).alias("is_weekday"),
    )
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    marks = holidays.toDF("_h").distinct()
    return out.join(marks, F.col("date") == F.col("_h"), "left").withColumn(
        "is_holiday", F.col("_h").isNotNull()
    ).drop("_h")
