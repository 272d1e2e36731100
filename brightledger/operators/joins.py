"""Join patterns.

No join carries a broadcast hint: Spark broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` and AQE splits skewed partitions beyond it.
Facts are summed to the join key first where the result allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import cents, dbl, mean_of, money, r2


def category_profit(lines: DataFrame, cats: DataFrame) -> DataFrame:
    """Inner join with a computed profit."""
    return lines.join(cats, "category").select(
        "sale_date",
        "category",
        dbl("category_revenue").alias("category_revenue"),
        r2(dbl("category_revenue") * F.col("margin_pct")).alias("estimated_profit"),
    )


def high_margin(lines: DataFrame, cats: DataFrame, min_margin: float) -> DataFrame:
    """Inner join whose condition also tests the dimension."""
    cond = (lines.category == cats.category) & (cats.margin_pct >= min_margin)
    return lines.join(cats, cond).select(
        lines.sale_date, lines.category, dbl(lines.category_revenue).alias("category_revenue")
    )


def left_with_orphans(sales: DataFrame, dim: DataFrame) -> DataFrame:
    joined = sales.join(dim, sales.part_id == dim.p_partkey, "left")
    return joined.select("part_id", dbl("amount").alias("amount"), "num_lines", F.col("p_name").alias("part_name"))


def orphans(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows without a match: the left-join-is-null pattern as an anti join."""
    return sales.join(dim, sales.part_id == dim.p_partkey, "left_anti").select(
        "part_id", dbl("amount").alias("amount"), "num_lines"
    )


def right_all_dim(sales: DataFrame, dim: DataFrame) -> DataFrame:
    joined = sales.join(dim, sales.part_id == dim.p_partkey, "right")
    return joined.select("p_partkey", F.col("p_name").alias("part_name"), "part_id", dbl("amount").alias("amount"))


def full_both(sales: DataFrame, dim: DataFrame) -> DataFrame:
    joined = sales.join(dim, sales.part_id == dim.p_partkey, "full")
    return joined.select(
        F.coalesce("part_id", "p_partkey").alias("part_key"),
        F.col("p_name").alias("part_name"),
        dbl("amount").alias("amount"),
    )


def grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row of one small list beside every row of another.

    The grid is the result itself, so both sides must be key lists (days of the calendar,
    categories of a dimension), never fact rows. Spark plans the cross join of the distinct keys by their size.
    """
    return left.distinct().crossJoin(right.distinct())


def beside_scalar(df: DataFrame, aggregates: dict) -> DataFrame:
    """Every row beside whole-table aggregates of the same frame, read as scalar subqueries."""
    return df.select("*", *[df.select(agg).scalar().alias(name) for name, agg in aggregates.items()])


def day_over_day(daily: DataFrame) -> DataFrame:
    """Each day beside the calendar day before it; days without a predecessor drop out."""
    t, y = daily.alias("t"), daily.alias("y")
    cond = F.col("t.sale_date") == F.date_add(F.col("y.sale_date"), 1)
    return t.join(y, cond).select(
        F.col("t.sale_date").alias("today"),
        dbl("t.daily_revenue").alias("today_rev"),
        F.col("y.sale_date").alias("yesterday"),
        dbl("y.daily_revenue").alias("yesterday_rev"),
        dbl(F.col("t.daily_revenue") - F.col("y.daily_revenue")).alias("day_over_day"),
    )


def regional_revenue(
    lineitem: DataFrame, part: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Chain of inner joins: line, part, supplier, nation, region.

    Lines are summed to (part, supplier) before the first join, and again to
    (type, supplier) before the second.
    """
    by_part = lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum(cents("l_extendedprice")).alias("_c"))
    by_type = (
        by_part.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type", "l_suppkey")
        .agg(F.sum("_c").alias("_c"))
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return (
        by_type.join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("p_type").alias("category"), F.col("r_name").alias("region"))
        .agg(F.sum("_c").alias("_c"))
        .select("category", "region", dbl(money("_c")).alias("regional_revenue"))
    )


def category_totals(lines: DataFrame, cats: DataFrame) -> DataFrame:
    """Aggregate by the key, then join the few totals to the dimension: same rows, far fewer joined."""
    totals = lines.groupBy("category").agg(
        F.count(F.lit(1)).alias("num_records"),
        dbl(F.sum("category_revenue")).alias("total_revenue"),
        r2(mean_of("category_revenue")).alias("avg_revenue"),
    )
    return totals.join(cats, "category").select(
        "category", "margin_pct", "num_records", "total_revenue", "avg_revenue"
    )


def beside_week_mean(daily: DataFrame) -> DataFrame:
    """Each day joined to its week's mean on an expression, the Monday of the date."""
    weeks = daily.groupBy(D.week_start("sale_date").alias("week_start")).agg(
        r2(mean_of("daily_revenue")).alias("week_avg")
    )
    return daily.join(weeks, D.week_start("sale_date") == F.col("week_start"), "left").select(
        "sale_date", dbl("daily_revenue").alias("daily_revenue"), "week_start", "week_avg"
    )


def active_customers(customer: DataFrame, orders: DataFrame, as_of: str, days: int) -> DataFrame:
    """Customers IN (those who ordered in the last days)."""
    recent = orders.where(
        F.col("o_orderdate") >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    ).select("o_custkey").distinct()
    return customer.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


def new_and_repeat(visits: DataFrame, date: str, customer: str) -> DataFrame:
    """Per day, customers on their first day and customers seen on an earlier day.

    Same answer as counting EXISTS / NOT EXISTS of an earlier row. The visits shrink to one row
    per (customer, day) first, so a customer with a third of all rows still gives
    a window of at most one row per calendar day.
    """
    pairs = visits.select(date, customer).distinct()
    first = F.min(date).over(W.partitionBy(customer))
    return (
        pairs.withColumn("_first", first)
        .groupBy(date)
        .agg(
            F.count_if(F.col(date) == F.col("_first")).alias("new_customers"),
            F.count_if(F.col(date) > F.col("_first")).alias("repeat_customers"),
        )
    )
