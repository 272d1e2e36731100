"""Money and rounding.

Sums of money run on whole cents (exact, order-free, one long per partial aggregate)
and turn into DECIMAL at the day grain. Rounded output uses ``floor(x * 10^n + 0.5) / 10^n``
on doubles, because engines disagree on ROUND of binary floats.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c: ColumnOrName) -> Column:
    """A non-negative amount in a double column as whole cents (BIGINT)."""
    return F.floor(as_col(c) * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def money(cents_col: ColumnOrName) -> Column:
    """Whole cents as DECIMAL(20,2)."""
    return (as_col(cents_col).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def round_half_up(c: ColumnOrName, digits: int = 2) -> Column:
    """Round a number to ``digits`` decimals as a double; ties go up."""
    scale = float(10**digits)
    return F.floor(as_col(c).cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def r2(c: ColumnOrName) -> Column:
    return round_half_up(c, 2)


def dbl(c: ColumnOrName) -> Column:
    return as_col(c).cast("double")


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as a double, NULL where den is 0."""
    d = as_col(den).cast("double")
    return as_col(num).cast("double") / F.nullif(d, F.lit(0.0))


def mean_of(c: ColumnOrName) -> Column:
    """Average as exact sum over count, so every engine makes the same two rounding steps."""
    x = as_col(c)
    return F.sum(x).cast("double") / F.nullif(F.count(x).cast("double"), F.lit(0.0))


def zscore(c: ColumnOrName, mean: Column, std: Column) -> Column:
    """|c - mean| / std, NULL where std is 0."""
    return F.abs(as_col(c).cast("double") - mean) / F.nullif(std, F.lit(0.0))


def min_max_scale(c: ColumnOrName, low: Column, high: Column, digits: int = 4) -> Column:
    """Scale into 0..1 with the guards NULL -> NULL and equal bounds -> 0."""
    x, lo, hi = as_col(c).cast("double"), low.cast("double"), high.cast("double")
    missing = x.isNull() | lo.isNull() | hi.isNull()
    return (
        F.when(missing, F.lit(None).cast("double"))
        .when(hi == lo, F.lit(0.0))
        .otherwise(round_half_up((x - lo) / F.nullif(hi - lo, F.lit(0.0)), digits))
    )


def tier(c: ColumnOrName, bounds: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound that ``c`` reaches, in the order given."""
    x = as_col(c)
    expr = None
    for bound, label in bounds:
        cond = x >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def hash_uniform(key: Column, low: float, high: float) -> Column:
    """Uniform value in [low, high) drawn from md5 of ``key``: equal at any partitioning and in any engine."""
    unit = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    return F.lit(float(low)) + unit * F.lit(float(high) - float(low))
