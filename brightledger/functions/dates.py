"""Date helpers. Differences count unit boundaries crossed; weekday 0 is Sunday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import ColumnOrName, as_col


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(as_col(d), "MM")


def quarter_start(d: ColumnOrName) -> Column:
    return F.trunc(as_col(d), "QUARTER")


def year_start(d: ColumnOrName) -> Column:
    return F.trunc(as_col(d), "YEAR")


def week_start(d: ColumnOrName) -> Column:
    """Monday of the week."""
    return F.trunc(as_col(d), "WEEK")


def dow0(d: ColumnOrName) -> Column:
    """Weekday number, 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(as_col(d)) - F.lit(1)


def iso_dow(d: ColumnOrName) -> Column:
    """Weekday number, 1 = Monday ... 7 = Sunday."""
    return F.weekday(as_col(d)) + F.lit(1)


def is_weekend(d: ColumnOrName) -> Column:
    return dow0(d).isin(0, 6)


def is_holiday_season(d: ColumnOrName) -> Column:
    return F.month(as_col(d)).isin(11, 12)


def week_end(d: ColumnOrName) -> Column:
    return F.date_add(week_start(d), 6)


def year_end(d: ColumnOrName) -> Column:
    return F.make_date(F.year(as_col(d)), F.lit(12), F.lit(31))


def add_weeks(d: ColumnOrName, n: int) -> Column:
    return F.date_add(as_col(d), 7 * n)


def add_years(d: ColumnOrName, n: int) -> Column:
    """Same day ``n`` years away; 29 February becomes 28 February."""
    return F.add_months(as_col(d), 12 * n)


def diff_days(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Day boundaries from a to b."""
    return F.datediff(as_col(b), as_col(a))


def diff_weeks(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Monday boundaries from a to b."""
    return (F.datediff(week_start(b), week_start(a)) / F.lit(7)).cast("int")


def diff_months(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Month boundaries from a to b."""
    a, b = as_col(a), as_col(b)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def diff_years(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Year boundaries from a to b."""
    return F.year(as_col(b)) - F.year(as_col(a))


def _epoch_seconds(ts: Column) -> Column:
    """Whole seconds of a timestamp without zone, without passing through the session zone."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.extract(F.lit("SECOND"), ts)).cast("bigint")


def trunc_wall(ts: ColumnOrName, unit: str) -> Column:
    """Truncate a timestamp without zone to second, minute, hour or day, without passing through the session zone."""
    ts = as_col(ts)
    units = ("day", "hour", "minute", "second")
    kept = units[: units.index(unit) + 1]
    d = ts.cast("date")
    second = F.floor(F.extract(F.lit("SECOND"), ts))
    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d),
        F.hour(ts) if "hour" in kept else F.lit(0),
        F.minute(ts) if "minute" in kept else F.lit(0),
        (second if "second" in kept else F.lit(0)).cast("decimal(16,6)"),
    )


def diff_hours(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Hour boundaries from timestamp a to timestamp b."""
    return F.floor(_epoch_seconds(as_col(b)) / 3600) - F.floor(_epoch_seconds(as_col(a)) / 3600)


def diff_minutes(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Minute boundaries from timestamp a to timestamp b."""
    return F.floor(_epoch_seconds(as_col(b)) / 60) - F.floor(_epoch_seconds(as_col(a)) / 60)


def date_key(d: ColumnOrName) -> Column:
    """YYYYMMDD as an integer."""
    d = as_col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(d: ColumnOrName) -> Column:
    """YYYYMM as an integer."""
    return F.year(as_col(d)) * 100 + F.month(as_col(d))


def quarter_key(d: ColumnOrName) -> Column:
    """YYYYQ as an integer."""
    return F.year(as_col(d)) * 10 + F.quarter(as_col(d))


def date_from_key(k: ColumnOrName) -> Column:
    """YYYYMMDD back to a date."""
    return F.to_date(as_col(k).cast("string"), "yyyyMMdd")


def age_bucket(
    d: ColumnOrName,
    as_of: ColumnOrName,
    bounds: tuple[int, ...] = (30, 90, 365),
    labels: tuple[str, ...] = ("RECENT", "THIS QUARTER", "THIS YEAR", "OLDER"),
) -> Column:
    """Label of the first bound that the age in days does not exceed; the last label is for the rest."""
    age = diff_days(d, as_of)
    expr = None
    for bound, label in zip(bounds, labels):
        cond = age <= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def convert_zone(ts: ColumnOrName, source: str, target: str) -> Column:
    """Wall-clock time in ``target`` of a wall-clock time in ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(target), as_col(ts))
