"""Aggregations and reports. Rows at the day grain keep money as DECIMAL, so sums are exact in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import cents, dbl, mean_of, money, r2, ratio
from .basics import revenue_tier

REV, N = "daily_revenue", "num_orders"

# The metric names of the exploration report.
EXPLORATION = (
    "Total Records", "Date Range", "Average Daily Revenue", "Total Revenue", "Min Daily Revenue", "Max Daily Revenue",
)


def summary(daily: DataFrame) -> DataFrame:
    """Whole-table count, dates, mean, range and totals."""
    return daily.agg(
        F.count(F.lit(1)).alias("total_days"),
        F.min("sale_date").alias("first_date"),
        F.max("sale_date").alias("last_date"),
        r2(mean_of(REV)).alias("avg_daily_revenue"),
        dbl(F.min(REV)).alias("min_daily_revenue"),
        dbl(F.max(REV)).alias("max_daily_revenue"),
        F.sum(N).alias("total_orders"),
        dbl(F.sum(REV)).alias("total_revenue"),
    )


def monthly(daily: DataFrame) -> DataFrame:
    """Revenue, mean and days per month."""
    return daily.groupBy(D.month_start("sale_date").alias("month")).agg(
        dbl(F.sum(REV)).alias("total_revenue"),
        F.sum(N).alias("total_orders"),
        r2(mean_of(REV)).alias("avg_revenue"),
        F.count(F.lit(1)).alias("days_in_month"),
    )


def by_weekday(daily: DataFrame, since: str | None = None) -> DataFrame:
    rows = daily if since is None else daily.where(F.col("sale_date") >= F.lit(since).cast("date"))
    return rows.groupBy(F.dayname("sale_date").alias("weekday"), D.dow0("sale_date").alias("weekday_num")).agg(
        F.count(F.lit(1)).alias("num_days"),
        r2(mean_of(REV)).alias("avg_revenue"),
        dbl(F.sum(REV)).alias("total_revenue"),
    )


def quarter_stats(daily: DataFrame, approximate: bool = False) -> DataFrame:
    """Min, max, median and sample deviation per quarter.

    A quarter holds at most 92 day rows, so the exact median is cheap; for groups without
    such a bound pass ``approximate=True``.
    """
    median = F.percentile_approx(dbl(REV), 0.5) if approximate else F.median(dbl(REV))
    return daily.groupBy(D.quarter_start("sale_date").alias("quarter")).agg(
        F.count(F.lit(1)).alias("days"),
        dbl(F.min(REV)).alias("min_rev"),
        dbl(F.max(REV)).alias("max_rev"),
        r2(median).alias("median_rev"),
        r2(F.stddev(dbl(REV))).alias("stddev_rev"),
    )


def by_tier(daily: DataFrame, value: str = "revenue_index", bounds=None) -> DataFrame:
    return daily.groupBy(revenue_tier(value, bounds).alias("revenue_tier")).agg(
        F.count(F.lit(1)).alias("num_days"), r2(mean_of(REV)).alias("avg_rev_in_tier")
    )


def months_having(daily: DataFrame, condition: Column, weekdays_only_since: str | None = None) -> DataFrame:
    """Monthly totals filtered by an aggregate: ``condition`` reads _sum, _mean or _days."""
    rows = daily
    if weekdays_only_since is not None:
        rows = rows.where(
            (F.col("sale_date") >= F.lit(weekdays_only_since).cast("date")) & ~F.dayname("sale_date").isin("Sat", "Sun")
        )
    return (
        rows.groupBy(D.month_start("sale_date").alias("month"))
        .agg(F.sum(REV).alias("_sum"), F.count(F.lit(1)).alias("_days"), mean_of(REV).alias("_mean"))
        .where(condition)
        .select(
            "month",
            dbl("_sum").alias("total_revenue"),
            F.col("_days").alias("selling_days"),
            r2("_mean").alias("avg_daily_revenue"),
        )
    )


def conditional_counts(daily: DataFrame) -> DataFrame:
    """Counts and sums under a condition, in one pass."""
    weekend = D.is_weekend("sale_date")
    return daily.agg(
        F.count_if(weekend).alias("weekend_days"),
        F.count_if(~weekend).alias("weekday_days"),
        dbl(F.sum(F.when(weekend, F.col(REV)).otherwise(F.lit(0)))).alias("weekend_revenue"),
        dbl(F.sum(F.when(~weekend, F.col(REV)).otherwise(F.lit(0)))).alias("weekday_revenue"),
        F.count_if(F.col(N) > 5).alias("busy_days"),
    )


def distinct_counts(orders: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct customers and days per status.

    The exact form counts days from sums by (status, day), which the calendar bounds, and customers from (status, customer), so that no row is expanded and a
    hot status is spread before it is counted. The approximate form is a mergeable sketch of the customers per (status, day), merged over the days.
    """
    day = F.col("o_orderdate").cast("date").alias("_day")
    sketch = [F.hll_sketch_agg(F.col("o_custkey").cast("bigint")).alias("_s")] if approximate else []
    days = orders.groupBy("o_orderstatus", day).agg(F.count(F.lit(1)).alias("_n"), *sketch)
    merged = [F.hll_sketch_estimate(F.hll_union_agg("_s")).alias("customers")] if approximate else []
    by_status = days.groupBy("o_orderstatus").agg(*merged, F.count("_day").alias("days"), F.sum("_n").alias("num_orders"))
    if not approximate:
        pairs = orders.groupBy("o_orderstatus", "o_custkey").agg(F.lit(1).alias("_one"))
        customers = pairs.groupBy(F.col("o_orderstatus").alias("_status")).agg(F.count("o_custkey").alias("customers"))
        by_status = by_status.join(customers, F.col("o_orderstatus").eqNullSafe(F.col("_status")))
    return by_status.select("o_orderstatus", "customers", "days", "num_orders")


def text_per_group(df: DataFrame, key: str, text: str, order: str, sep: str = ". ") -> DataFrame:
    """LISTAGG ... WITHIN GROUP: the whole text of each group in order, one row per group."""
    sql = (
        f"SELECT {key}, listagg({text}, :sep) WITHIN GROUP (ORDER BY {order}) AS full_text, "
        f"count(*) AS num_texts FROM {{src}} GROUP BY {key}"
    )
    return df.sparkSession.sql(sql, args={"sep": sep}, src=df)


def values_per_month(daily: DataFrame) -> DataFrame:
    """Ordered array of daily revenues per month (at most 31 values) and its size."""
    pairs = F.array_sort(F.collect_list(F.struct("sale_date", REV)))
    return (
        daily.groupBy(D.month_start("sale_date").alias("month"))
        .agg(pairs.alias("_p"))
        .select(
            "month",
            F.transform("_p", lambda p: p[REV]).alias("daily_revenues"),
            F.size("_p").alias("num_days"),
        )
    )


def silver_monthly(silver: DataFrame) -> DataFrame:
    """Monthly view over the cleaned daily table."""
    return silver.groupBy(
        D.month_start("sale_date").alias("month_date"),
        F.year("sale_date").alias("year"),
        F.month("sale_date").alias("month"),
    ).agg(
        F.count(F.lit(1)).alias("num_days"),
        dbl(F.sum(REV)).alias("total_revenue"),
        r2(mean_of(REV)).alias("avg_daily_revenue"),
        dbl(F.min(REV)).alias("min_daily_revenue"),
        dbl(F.max(REV)).alias("max_daily_revenue"),
        r2(F.stddev(dbl(REV))).alias("stddev_daily_revenue"),
        F.sum(N).alias("total_orders"),
        r2(mean_of(N)).alias("avg_daily_orders"),
        r2(ratio(F.sum(REV), F.sum(N))).alias("revenue_per_order"),
    )


def silver_quarterly(silver: DataFrame) -> DataFrame:
    """Quarterly view over the cleaned daily table."""
    return silver.groupBy(F.year("sale_date").alias("year"), F.quarter("sale_date").alias("quarter")).agg(
        F.count(F.lit(1)).alias("num_days"),
        dbl(F.sum(REV)).alias("total_revenue"),
        r2(mean_of(REV)).alias("avg_daily_revenue"),
        r2(ratio(F.sum(REV), F.count(F.lit(1)))).alias("avg_revenue"),
        F.sum(N).alias("total_orders"),
        r2(mean_of(N)).alias("avg_daily_orders"),
        r2(ratio(F.sum(REV), F.sum(N))).alias("revenue_per_order"),
        dbl(F.min(REV)).alias("min_revenue"),
        dbl(F.max(REV)).alias("max_revenue"),
    )


def silver_day_analysis(silver: DataFrame) -> DataFrame:
    """Weekday pattern over the cleaned daily table."""
    return silver.groupBy(
        F.dayname("sale_date").alias("day_name"),
        D.dow0("sale_date").alias("day_of_week"),
        D.is_weekend("sale_date").alias("is_weekend"),
    ).agg(
        F.count(F.lit(1)).alias("num_occurrences"),
        r2(mean_of(REV)).alias("avg_revenue"),
        dbl(F.sum(REV)).alias("total_revenue"),
        dbl(F.min(REV)).alias("min_revenue"),
        dbl(F.max(REV)).alias("max_revenue"),
        r2(mean_of(N)).alias("avg_orders"),
        F.sum(N).alias("total_orders"),
    )


def gold_agg_monthly(fact: DataFrame) -> DataFrame:
    """Monthly summary table with the weekend and weekday split."""
    weekend = D.is_weekend("sale_date")
    return fact.groupBy(
        D.month_key("sale_date").alias("month_key"),
        D.month_start("sale_date").alias("month_date"),
        F.year("sale_date").alias("year"),
        F.month("sale_date").alias("month"),
    ).agg(
        F.count(F.lit(1)).alias("num_days"),
        dbl(F.sum(REV)).alias("total_revenue"),
        r2(mean_of(REV)).alias("avg_daily_revenue"),
        r2(F.stddev(dbl(REV))).alias("stddev_daily_revenue"),
        dbl(F.min(REV)).alias("min_daily_revenue"),
        dbl(F.max(REV)).alias("max_daily_revenue"),
        F.sum(N).alias("total_orders"),
        r2(mean_of(N)).alias("avg_daily_orders"),
        r2(ratio(F.sum(REV), F.sum(N))).alias("revenue_per_order"),
        F.count_if(weekend).alias("weekend_days"),
        F.count_if(~weekend).alias("weekday_days"),
        dbl(F.sum(F.when(weekend, F.col(REV)).otherwise(F.lit(0)))).alias("weekend_revenue"),
        dbl(F.sum(F.when(~weekend, F.col(REV)).otherwise(F.lit(0)))).alias("weekday_revenue"),
    )


def gold_agg_quarterly(fact: DataFrame) -> DataFrame:
    """Quarterly summary table with first and last day and the swing."""
    return fact.groupBy(
        D.quarter_key("sale_date").alias("quarter_key"),
        F.year("sale_date").alias("year"),
        F.quarter("sale_date").alias("quarter"),
    ).agg(
        F.min("sale_date").alias("quarter_start_date"),
        F.max("sale_date").alias("quarter_end_date"),
        F.count(F.lit(1)).alias("num_days"),
        dbl(F.sum(REV)).alias("total_revenue"),
        r2(mean_of(REV)).alias("avg_daily_revenue"),
        r2(ratio(F.sum(REV), F.count(F.lit(1)))).alias("avg_revenue"),
        F.sum(N).alias("total_orders"),
        r2(mean_of(N)).alias("avg_daily_orders"),
        r2(ratio(F.sum(REV), F.sum(N))).alias("revenue_per_order"),
        dbl(F.min(REV)).alias("min_daily_revenue"),
        dbl(F.max(REV)).alias("max_daily_revenue"),
        dbl(F.max(REV) - F.min(REV)).alias("revenue_swing"),
    )


def customer_days(orders: DataFrame) -> DataFrame:
    """State of the customer metrics, one row per (customer, day): sums, rows, and a sketch of the order keys. States of different loads are merged by ``merge_customer_days``."""
    return orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.sum(cents("o_totalprice")).alias("cents"),
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(F.col("o_orderkey").cast("bigint")).alias("order_sketch"),
    )


def merge_customer_days(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state after more orders: sums add up, sketches unite, so an order that comes twice is still one."""
    return state.unionByName(new).groupBy("o_custkey", "day").agg(
        F.sum("cents").alias("cents"), F.sum("rows").alias("rows"), F.hll_union_agg("order_sketch").alias("order_sketch")
    )


def _metrics(customer: DataFrame, facts: DataFrame) -> DataFrame:
    return customer.join(facts, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey",
        "c_name",
        F.coalesce("total_transactions", F.lit(0)).alias("total_transactions"),
        F.coalesce("days_with_purchase", F.lit(0)).alias("days_with_purchase"),
        dbl(money("_c")).alias("total_revenue"),
        r2(ratio(money("_c"), "_n")).alias("average_order_value"),
        D.date_key("_last").alias("last_purchase_date"),
        D.date_key("_first").alias("first_purchase_date"),
        F.datediff("_last", "_first").alias("customer_lifetime_days"),
    )


def _by_customer(days: DataFrame, cents: str, rows: str, *more: Column) -> DataFrame:
    """Days, sums and span of each customer, from one row per (customer, day)."""
    return days.groupBy("o_custkey").agg(
        F.count("day").alias("days_with_purchase"), F.sum(cents).alias("_c"), F.sum(rows).alias("_n"),
        F.min("day").alias("_first"), F.max("day").alias("_last"), *more,
    )


def customer_metrics_from(customer: DataFrame, state: DataFrame) -> DataFrame:
    """Customer metrics from the kept state: everything exact but the distinct transactions, which are the estimate of the united sketches."""
    transactions = F.hll_sketch_estimate(F.hll_union_agg("order_sketch")).alias("total_transactions")
    return _metrics(customer, _by_customer(state, "cents", "rows", transactions))


def customer_metrics(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Per customer: distinct transactions, active days, revenue, mean, first and last day, lifetime days.

    Each distinct count is an aggregate of its own: days from sums by (customer, day), transactions from (customer, order). No row is expanded for them, and a hot
    customer is spread over days and orders until few rows are left.
    """
    day = F.col("o_orderdate").cast("date").alias("day")
    days = orders.groupBy("o_custkey", day).agg(F.sum(cents("o_totalprice")).alias("cents"), F.count(F.lit(1)).alias("rows"))
    each = orders.groupBy(F.col("o_custkey").alias("_c2"), "o_orderkey").agg(F.lit(1).alias("_one"))
    transactions = each.groupBy("_c2").agg(F.count("o_orderkey").alias("total_transactions"))
    return _metrics(customer, _by_customer(days, "cents", "rows").join(transactions, F.col("o_custkey") == F.col("_c2")))


def customer_ltv(orders: DataFrame) -> DataFrame:
    """Lifetime value and distinct orders per customer."""
    return (
        orders.groupBy("o_custkey")
        .agg(F.sum(cents("o_totalprice")).alias("_c"), F.count_distinct("o_orderkey").alias("total_orders"))
        .select(
            F.col("o_custkey").alias("customer_id"), dbl(money("_c")).alias("lifetime_value"), "total_orders"
        )
    )


def customer_segments(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers and mean lifetime value per segment."""
    spent = orders.groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("_c"))
    return (
        customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy(F.col("c_mktsegment").alias("customer_segment"))
        .agg(F.count(F.lit(1)).alias("customer_count"), r2(mean_of(money("_c"))).alias("avg_ltv"))
    )


def exploration(daily: DataFrame) -> DataFrame:
    """Six metrics as rows (metric, date, number, text): one aggregate pass, then unpivoted."""
    one = daily.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("sale_date").alias("lo"),
        F.max("sale_date").alias("hi"),
        r2(mean_of(REV)).alias("mean"),
        dbl(F.sum(REV)).alias("total"),
        dbl(F.min(REV)).alias("low"),
        dbl(F.max(REV)).alias("high"),
    )
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    dates = F.concat(F.col("lo").cast("string"), F.lit(" to "), F.col("hi").cast("string"))
    values = [(number, F.col("n").cast("string")), (number, dates), *[(F.col(c), text) for c in ("mean", "total", "low", "high")]]
    rows = [
        F.struct(
            F.lit(name).alias("metric"), F.lit(None).cast("date").alias("date_dimension"),
            v.alias("value_numeric"), t.alias("value_text"),
        )
        for name, (v, t) in zip(EXPLORATION, values)
    ]
    return one.select(F.inline(F.array(*rows)))


def kpis(daily: DataFrame) -> DataFrame:
    return daily.agg(
        dbl(F.sum(REV)).alias("total_revenue"),
        r2(mean_of(REV)).alias("avg_daily_revenue"),
        F.sum(N).alias("total_orders"),
    )


def explorer(daily: DataFrame, min_revenue: float, first: str, last: str) -> DataFrame:
    span = F.col("sale_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return daily.where((dbl(REV) >= min_revenue) & span).select(
        "sale_date", dbl(REV).alias(REV), N, r2(ratio(REV, N)).alias("rev_per_order")
    )


def seasonality(daily: DataFrame) -> DataFrame:
    """Mean revenue by month of year, and for weekdays against weekends, from one pass over (month, weekend) cells."""
    cells = daily.groupBy(F.month("sale_date").alias("m"), D.is_weekend("sale_date").alias("we")).agg(
        F.sum(REV).alias("s"), F.count(F.lit(1)).alias("n")
    )
    kind = F.explode(
        F.array(
            F.struct(F.lit("month").alias("kind"), F.col("m").cast("string").alias("label")),
            F.struct(
                F.lit("day type").alias("kind"),
                F.when(F.col("we"), F.lit("weekend")).otherwise(F.lit("weekday")).alias("label"),
            ),
        )
    )
    return (
        cells.select("s", "n", kind.alias("k"))
        .groupBy("k.kind", "k.label")
        .agg(r2(ratio(F.sum("s"), F.sum("n"))).alias("avg_revenue"), F.sum("n").alias("num_days"))
    )


def best_and_worst_month(daily: DataFrame) -> DataFrame:
    """The best and the worst month by revenue; the earlier month wins a tie."""
    months = daily.groupBy(D.month_start("sale_date").alias("month")).agg(
        F.sum(REV).alias("rev"), F.sum(N).alias("orders"), F.count(F.lit(1)).alias("days")
    )
    back = -F.unix_date("month")
    one = months.agg(
        F.max_by(F.struct("month", "rev", "orders", "days"), F.struct("rev", back)).alias("best"),
        F.min_by(F.struct("month", "rev", "orders", "days"), F.struct("rev", F.unix_date("month"))).alias("worst"),
    )
    rows = F.explode(F.array(
        F.struct(F.lit("best").alias("which"), F.col("best").alias("m")),
        F.struct(F.lit("worst").alias("which"), F.col("worst").alias("m")),
    ))
    return one.select(rows.alias("r")).select(
        "r.which",
        F.col("r.m.month").alias("month"),
        dbl("r.m.rev").alias("total_revenue"),
        F.col("r.m.orders").alias("total_orders"),
        F.col("r.m.days").alias("selling_days"),
    )
