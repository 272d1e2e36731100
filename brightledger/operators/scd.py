"""Customer cleaning and slowly changing dimensions of type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strings as S
from ..sources.parts import PartTable
from .layout import stored
from .windows import dedup_latest

VERSION_COLUMNS = ["effective_date", "end_date", "is_current"]


def silver_customer(raw: DataFrame, as_of: str, order: Sequence[str] = ("_load_date",)) -> DataFrame:
    """Cleaned customers: trimmed upper-case key, lower-case mail, mail flag, latest load per key."""
    extra = [c for c in raw.columns if c not in ("id", "name", "email", *order)]
    clean = raw.where(F.col("id").isNotNull()).select(
        S.clean_key("id").alias("customer_id"),
        F.trim("name").alias("customer_name"),
        S.clean_email("email").alias("email"),
        *extra,
        F.coalesce(S.looks_like_email("email"), F.lit(False)).alias("is_valid_email"),
        *order,
    )
    # All columns break a tie between rows of the same load, so a rerun picks the same row.
    return dedup_latest(clean, ["customer_id"], [*order, "customer_name", "email", *extra]).select(
        "customer_id", "customer_name", "email", *extra, "is_valid_email",
        F.lit(True).alias("is_active"),
        F.lit(as_of).cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(
    current: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str], as_of: str, unique: bool = False
) -> DataFrame:
    """The next state of a type 2 dimension.

    A key whose attributes changed closes on the day before ``as_of`` and opens a new version; a new key
    opens a version; an unchanged or absent key stays. A version that opened on that day or later is replaced, as it would end before it began. Of incoming rows
    with the same key the one with the greatest attributes counts; ``unique`` says that there are none, which saves a sort. Closed history passes through untouched.
    One outer join of the open rows on the key; each match yields one or two rows.
    """
    today = F.lit(as_of).cast("date")
    extra = [c for c in current.columns if c not in [*keys, *attrs, *VERSION_COLUMNS]]
    history = current.where(~F.col("is_current"))
    old = current.where(F.col("is_current")).alias("o")
    if not unique:
        incoming = incoming.groupBy(*keys).agg(F.max(F.struct(*attrs)).alias("_a")).select(*keys, *[F.col(f"_a.{a}").alias(a) for a in attrs])
    new = incoming.select(*keys, *attrs, F.lit(True).alias("_new")).alias("n")
    cond = None
    for k in keys:
        c = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        cond = c if cond is None else cond & c
    both = old.join(new, cond, "full")

    def version(side: str, start, end, current_flag):
        values = [F.col(f"{side}.{c}").alias(c) for c in [*keys, *attrs]]
        kept = [(F.col(f"o.{c}")).alias(c) for c in extra]
        return F.struct(*values, *kept, start.alias("effective_date"), end.alias("end_date"), current_flag.alias("is_current"))

    open_end = F.lit(None).cast("date")
    was, is_in = F.col("o.is_current").isNotNull(), F.col("n._new").isNotNull()
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(f"o.{a}").eqNullSafe(F.col(f"n.{a}"))
    keep = version("o", F.col("o.effective_date"), open_end, F.lit(True))
    close = version("o", F.col("o.effective_date"), F.date_sub(today, 1), F.lit(False))
    start = version("n", today, open_end, F.lit(True))
    again = version("n", F.col("o.effective_date"), open_end, F.lit(True))
    changed = was & is_in & ~same
    rows = F.when(changed & (F.col("o.effective_date") >= today), F.array(again)).when(changed, F.array(close, start)).when(was, F.array(keep)).otherwise(F.array(start))
    merged = both.select(F.inline(rows)).select(*current.columns)
    return history.unionByName(merged)


class Scd2Table:
    """A type 2 dimension as a stored table. Open rows lie in buckets of their keys; the versions that a merge closes are a part of their own.

    A merge reads the open rows of the buckets that incoming keys fall into, and rewrites those in which a key is new or changed. Closed history is never read or written again,
    other than by a second merge on the same day.
    """

    PART = "_part"

    def __init__(self, spark: SparkSession, path: str, ddl: str, keys: Sequence[str], attrs: Sequence[str], buckets: int = 64):
        self.keys, self.attrs, self.buckets = list(keys), list(attrs), buckets
        columns = f"{ddl}, effective_date date, end_date date, is_current boolean"
        self.table = PartTable(spark, path, f"{columns}, {self.PART} string", self.PART)
        self.columns = [c for c in self.table.schema.fieldNames() if c != self.PART]

    def _open(self) -> Column:
        return F.concat(F.lit("open-"), F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string"))

    def _parts(self, rows: DataFrame) -> list[str]:
        """Names of buckets, as many as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self._open()).distinct().collect())

    def merge(self, incoming: DataFrame, as_of: str) -> list[str]:
        """Take in the present rows of some or all keys. Returns the parts that were rewritten."""
        incoming = incoming.select(*self.keys, *self.attrs)
        open_rows = self.table.read(self._parts(incoming)).select(*self.columns)
        same = [*self.keys, *self.attrs]
        met = F.lit(True)
        for c in same:
            met = met & F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
        changed = stored(incoming.alias("n").join(open_rows.alias("o"), met, "left_anti"), "changed")
        touched = self._parts(changed)
        if not touched:
            return []
        closed = f"closed-{as_of}"
        rows = self.table.read([*touched, closed]).select(*self.columns)
        # All rows of a key that has a changed one, so that the same row of it is chosen as if all were merged.
        same_key = F.lit(True)
        for k in self.keys:
            same_key = same_key & F.col(f"n.{k}").eqNullSafe(F.col(f"c.{k}"))
        again = incoming.alias("n").join(changed.alias("c"), same_key, "left_semi")
        merged = scd2_merge(rows, again, self.keys, self.attrs, as_of)
        part = F.when(F.col("is_current"), self._open()).otherwise(F.lit(closed))
        self.table.replace(merged.withColumn(self.PART, part), [*touched, closed])
        return touched

    def read(self) -> DataFrame:
        """All versions."""
        return self.table.read().select(*self.columns)

    def current(self) -> DataFrame:
        """Open versions; closed ones are not opened."""
        return self.table.read(p for p in self.table.parts() if p.startswith("open-")).select(*self.columns)


def scd2_current(dim: DataFrame) -> DataFrame:
    """Open rows, and only active ones where the dimension says so."""
    rows = dim.where(F.col("is_current"))
    return rows.where(F.col("is_active")) if "is_active" in dim.columns else rows


def scd2_history(dim: DataFrame, key: str, value) -> DataFrame:
    """All versions of one key, newest first."""
    return dim.where(F.col(key) == F.lit(value)).orderBy(F.desc("effective_date"))
