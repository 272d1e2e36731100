"""Facts and dimensions of the top layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import dbl, r2, ratio
from .keys import dense_numbers
from .windows import dedup_latest, prior_year, zscore_window

MONEY = "decimal(18,2)"


def silver_daily_sales(bronze: DataFrame, dedup: bool = False, max_z: float | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Positive days with calendar features, revenue per order, flags and a centred z-score.

    By default rows are only flagged; ``dedup`` keeps one row per day and ``max_z`` drops outliers. With ``keys`` every key is a series of its own.
    """
    rows = bronze.where((F.col("daily_revenue") > 0) & (F.col("num_orders") > 0))
    if dedup:
        rows = dedup_latest(rows, [*keys, "sale_date"], ["daily_revenue", "num_orders"])
    scored = zscore_window(rows, "daily_revenue", "sale_date", keys=keys)
    if max_z is not None:
        scored = scored.where(F.col("revenue_zscore").isNull() | (F.col("revenue_zscore") <= max_z))
    d = "sale_date"
    return scored.select(
        *keys, d, "daily_revenue", "num_orders",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        D.dow0(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        r2(ratio("daily_revenue", "num_orders")).alias("revenue_per_order"),
        D.is_weekend(d).alias("is_weekend"),
        D.is_holiday_season(d).alias("is_holiday_season"),
        "revenue_zscore",
    )


def gold_fact_daily(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Daily fact: date key, rolling sums, month to date, same day last year, flags; one series per key."""
    d = "sale_date"
    run = W.partitionBy(*keys).orderBy(d)
    month = W.partitionBy(*keys, "year", "month").orderBy(d)
    out = silver.select(
        *keys, D.date_key(d).alias("date_key"), d, "daily_revenue", "num_orders", "revenue_per_order",
        "year", "month", "quarter", "day_of_week", "week_of_year", "is_weekend", "is_holiday_season",
        dbl(F.sum("daily_revenue").over(run.rowsBetween(-6, 0))).alias("revenue_7day_rolling"),
        dbl(F.sum("daily_revenue").over(run.rowsBetween(-29, 0))).alias("revenue_30day_rolling"),
        dbl(F.sum("daily_revenue").over(month)).alias("revenue_month_to_date"),
    )
    return prior_year(out, d, "daily_revenue", keys=keys)


def gold_fact_sales(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Line fact with keys, measures in exact decimals, and flags.

    Keys come from the orders by one join on the order key. The list price comes from the parts.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    p = part.select("p_partkey", "p_retailprice")
    lines = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_amount"),
        F.col("l_discount").cast("decimal(4,2)").alias("_disc"),
        F.col("l_tax").cast("decimal(4,2)").alias("_tax"),
        "l_returnflag", "l_linestatus",
    )
    discount = F.round(F.col("total_amount") * F.col("_disc"), 2).cast(MONEY)
    tax = F.round((F.col("total_amount") - F.col("discount_amount")) * F.col("_tax"), 2).cast(MONEY)
    net = (F.col("total_amount") - F.col("discount_amount") + F.col("tax_amount")).cast(MONEY)
    return (
        lines.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("discount_amount", discount)
        .withColumn("tax_amount", tax)
        .withColumn("net_amount", net)
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            D.date_key("o_orderdate").alias("date_id"),
            "quantity",
            F.col("p_retailprice").cast(MONEY).alias("unit_price"),
            "total_amount", "discount_amount", "tax_amount", "net_amount",
            (F.col("l_returnflag") == "R").alias("is_return"),
            ((F.col("o_orderstatus") == "P") & (F.col("l_linestatus") == "F")).alias("is_cancelled"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        )
    )


def gold_agg_daily_sales(fact: DataFrame, day: int | None = None) -> DataFrame:
    """Totals per day, customer and product, with new and repeat customers counted on one day.

    That day is the last day of the fact unless given. Only its rows meet the customers seen before it; the totals of
    all other days need no join, so they are not moved for one, and no customer gathers its history.
    """
    last = fact.select(F.max("date_id")).scalar() if day is None else F.lit(day)
    on_day, other = F.col("date_id") == last, F.coalesce(F.col("date_id") != last, F.lit(True))

    def totals(rows: Column) -> DataFrame:
        return (
            fact.where(~F.col("is_cancelled") & rows)
            .groupBy("date_id", "customer_id", "product_id")
            .agg(
                F.sum("net_amount").alias("_net"),
                F.sum("quantity").alias("total_quantity"),
                F.count(F.lit(1)).alias("transaction_count"),
            )
        )

    seen = fact.where(F.col("date_id") < last).select(F.col("customer_id").alias("_c")).distinct()
    met = totals(on_day).join(seen, F.col("customer_id") == F.col("_c"), "left")
    joined = met.unionByName(totals(other).withColumn("_c", F.lit(None).cast(fact.schema["customer_id"].dataType)))
    return joined.select(
        "date_id", "customer_id", "product_id",
        dbl("_net").alias("total_sales"),
        "total_quantity", "transaction_count",
        r2(ratio("_net", "transaction_count")).alias("average_transaction_value"),
        F.when(on_day & F.col("_c").isNull(), 1).otherwise(0).alias("new_customers"),
        F.when(on_day & F.col("_c").isNotNull(), 1).otherwise(0).alias("repeat_customers"),
    )


def gold_dim_product(part: DataFrame) -> DataFrame:
    """Product dimension with a dense surrogate key. Runs a job."""
    rows = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("p_size") > 0).alias("is_active"),
    )
    return dense_numbers(rows, ["product_id"], "product_key")
