"""Hierarchies stored as parent ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def hierarchy(df: DataFrame, id: str, parent: str, label: str, sep: str = " > ") -> DataFrame:
    """Depth, path and indented label of every row that hangs below a root (a row without a parent).

    Every row keeps the stretch of its way up that it knows and the next id above it. A round joins each open stretch with the
    stretch of that id, so known stretches double and a tree of any depth takes as many rounds as its depth has binary digits.
    Rounds are checkpointed: the plan stays short and a lost executor does not replay the earlier ones. Rows whose way up ends at an
    unknown id are left out. An id that comes twice on one way up is a cycle, and raises a ValueError that names it.
    """
    shared_dir(df.sparkSession)
    nodes = df.select(F.col(id).alias("id"), F.col(parent).alias("parent"), F.col(label).alias("label"))
    ways = nodes.select("id", "parent", "label", F.col("parent").alias("up"), F.array("id").alias("ids"), F.col("label").alias("path")).checkpoint()
    while not (going := ways.where(F.col("up").isNotNull())).isEmpty():
        above = ways.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("ids").alias("_ids"), F.col("path").alias("_path"))
        longer = going.join(above, F.col("up") == F.col("_id")).select(
            "id", "parent", "label", F.col("_up").alias("up"), F.concat("_ids", "ids").alias("ids"), F.concat("_path", F.lit(sep), "path").alias("path")
        )
        ways = ways.where(F.col("up").isNull()).unionByName(longer).checkpoint()
        twice = ways.where(F.size(F.array_distinct("ids")) < F.size("ids")).select(
            F.filter("ids", lambda x: F.size(F.filter("ids", lambda y: y == x)) > 1)[0].alias("id")
        ).first()
        if twice is not None:
            raise ValueError(f"the hierarchy has a cycle through {twice.id!r}")
    depth = F.size("ids") - 1
    return ways.select(
        F.col("id").alias(id),
        F.col("parent").alias(parent),
        F.concat(F.repeat(F.lit("  "), depth), "label").alias("org_chart"),
        depth.alias("depth"),
        "path",
    )
