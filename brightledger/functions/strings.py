"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import ColumnOrName, as_col, r2, ratio


def clean_key(c: ColumnOrName) -> Column:
    return F.trim(F.upper(as_col(c)))


def clean_email(c: ColumnOrName) -> Column:
    return F.lower(F.trim(as_col(c)))


def looks_like_email(c: ColumnOrName) -> Column:
    """Something, @, something, dot, something."""
    return as_col(c).like("%@%.%")


def preview(c: ColumnOrName, n: int) -> Column:
    return F.concat(F.left(as_col(c), F.lit(n)), F.lit("..."))


def indent(c: ColumnOrName, depth: Column) -> Column:
    return F.concat(F.repeat(F.lit("  "), depth), as_col(c))


def email_domain(c: ColumnOrName) -> Column:
    """Lower-case text between the first and the second @; NULL without an @."""
    x = as_col(c)
    return F.when(F.contains(x, F.lit("@")), F.lower(F.split_part(x, F.lit("@"), F.lit(2))))


def rounded_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    return r2(ratio(num, den))
