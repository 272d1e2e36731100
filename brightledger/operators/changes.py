"""Change data and versions of keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = ["action", "is_update", "row_id"]


def row_id(keys: Sequence[str], side: str = "") -> Column:
    """A stable identifier of the row with these keys."""
    return F.md5(F.concat_ws("|", *[F.col(f"{side}{k}").cast("string") for k in keys]))


def net_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two versions of a table, with action, is_update and row id.

    An update gives its old row as DELETE and its new row as INSERT, both marked. What came and
    went in between does not show. One full join on the key.
    """
    cols = old.columns
    o = old.select(*cols, F.lit(True).alias("_here")).alias("o")
    n = new.select(*cols, F.lit(True).alias("_here")).alias("n")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))  # a NULL key is a key
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    was, now = F.col("o._here").isNotNull(), F.col("n._here").isNotNull()

    def image(side: str, action: str, update: bool) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in cols],
            F.lit(action).alias("action"), F.lit(update).alias("is_update"), row_id(keys, f"{side}.").alias("row_id"),
        )

    rows = (
        F.when(was & now, F.array(image("o", "DELETE", True), image("n", "INSERT", True)))
        .when(now, F.array(image("n", "INSERT", False)))
        .otherwise(F.array(image("o", "DELETE", False)))
    )
    return o.join(n, cond, "full").where(~(was & now & same)).select(F.inline(rows))


def without_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not among those of ``gone``; a NULL key is a key."""
    met = F.lit(True)
    for k in keys:
        met = met & F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}"))
    return df.alias("_l").join(gone.select(*keys).alias("_r"), met, "left_anti").select(*df.columns)


def appended(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the old version does not have."""
    return without_keys(new, old, keys)


def labelled(changes: DataFrame, keep_before: bool = False) -> DataFrame:
    """Changes with INSERT, UPDATE or DELETE; the old image of an update has no label and is left out by default."""
    insert, update = F.col("action") == "INSERT", F.col("is_update")
    label = (
        F.when(insert & ~update, F.lit("INSERT")).when(insert & update, F.lit("UPDATE")).when(~insert & ~update, F.lit("DELETE"))
    )
    out = changes.withColumn("change_type", label)
    return out if keep_before else out.where(F.col("change_type").isNotNull())


def apply_changes(
    df: DataFrame, set_values: dict[str, Column] | None = None, where: Column | None = None, delete_where: Column | None = None
) -> DataFrame:
    """UPDATE ... SET ... WHERE, then DELETE ... WHERE, as the rows of the next version."""
    out = df
    if set_values:
        hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        out = out.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in set_values.items()})
    if delete_where is not None:
        out = out.where(~F.coalesce(delete_where, F.lit(False)))
    return out


def upsert(df: DataFrame, updates: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``updates`` replace or join those of ``df``; keys in ``deletes`` go."""
    gone = updates.select(*keys).unionByName(deletes.select(*keys))
    return without_keys(df, gone, keys).unionByName(updates.select(*df.columns))


def log_rows(df: DataFrame, op: str, commit_ts: str, change_id: int) -> DataFrame:
    """Rows as entries of a kept change log: op I, U or D, commit time and change number."""
    return df.select(
        "*", F.lit(op).alias("op"), F.lit(commit_ts).cast("timestamp_ntz").alias("commit_ts"), F.lit(change_id).alias("change_id")
    )


def log_changes(changes: DataFrame, commit_ts: str, change_id: int) -> DataFrame:
    """Net changes as log entries."""
    op = F.substring("change_type", 1, 1)
    rows = labelled(changes).withColumn("op", op).drop("change_type", *META)
    return rows.withColumns({"commit_ts": F.lit(commit_ts).cast("timestamp_ntz"), "change_id": F.lit(change_id)})


def latest_state(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ("commit_ts", "change_id")) -> DataFrame:
    """Latest entry per key, without deleted keys. An aggregate with a map-side pass."""
    cols = [c for c in log.columns if c not in ("op", "commit_ts", "change_id")]
    rest = [c for c in cols if c not in keys]
    last = F.max_by(F.struct("op", *rest), F.struct(*order)).alias("_r")
    return (
        log.groupBy(*keys).agg(last).where(F.col("_r.op") != "D")
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*cols)
    )


def as_of(log: DataFrame, keys: Sequence[str], ts: str, offset_seconds: int = 0) -> DataFrame:
    """The table at a moment, or that many seconds before or after it."""
    at = F.lit(ts).cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(offset_seconds))
    return latest_state(log.where(F.col("commit_ts") <= at), keys)


def before_change(log: DataFrame, keys: Sequence[str], change_id: int) -> DataFrame:
    """The table just before a given change."""
    return latest_state(log.where(F.col("change_id") < change_id), keys)


def restore(current: DataFrame, log: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The current rows, and those of an earlier moment whose key is gone."""
    lost = without_keys(as_of(log, keys, ts), current, keys)
    return current.unionByName(lost.select(*current.columns))


def side_by_side(original: DataFrame, clone: DataFrame) -> DataFrame:
    """Both copies in one frame, told apart by ``source``."""
    tag = lambda df, name: df.select(F.lit(name).alias("source"), "*")
    return tag(original, "ORIGINAL").unionByName(tag(clone, "CLONE"))


def incremental_sum(batch: DataFrame, stored: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Stored sums plus those of a batch, per key."""
    both = stored.select(*keys, *sums).unionByName(batch.select(*keys, *sums))
    return both.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
