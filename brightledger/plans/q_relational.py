"""Projections, filters, joins, aggregations, reports and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import dbl
from ..operators import aggregates as A
from ..operators import basics as B
from ..operators import joins as J
from .registry import query
from .relations import sql_d, sql_dayname, sql_mean, sql_r, with_sql

REV = "CAST(daily_revenue AS DOUBLE) AS daily_revenue"
PLAIN = f"SELECT sale_date, {REV}, num_orders FROM daily"
TIER = (
    "CASE WHEN revenue_index >= 1.25 THEN 'HIGH' WHEN revenue_index >= 1 THEN 'MEDIUM' WHEN revenue_index >= 0.75 THEN 'LOW' ELSE 'VERY LOW' END"
)
MEAN_DAY = "(SELECT CAST(SUM(daily_revenue) AS DOUBLE) / COUNT(*) FROM daily)"
MONTH = "CAST(date_trunc('month', sale_date) AS DATE)"
QUARTER = "CAST(date_trunc('quarter', sale_date) AS DATE)"


def on_daily(body: str) -> str:
    return with_sql("daily", body)


# --- projections, filters, predicates -------------------------------------------------------

query(
    "filter_topn",
    on_daily(f"{PLAIN} WHERE CAST(daily_revenue AS DOUBLE) > {MEAN_DAY} AND sale_date >= DATE '1997-01-01' ORDER BY daily_revenue DESC, sale_date LIMIT 10"),
)(lambda t: B.top_days(t.daily, t.daily_mean(), "1997-01-01", 10))

query(
    "project_computed",
    on_daily(
        f"""SELECT sale_date, {REV}, num_orders,
              {sql_r('CAST(daily_revenue AS DOUBLE) / NULLIF(CAST(num_orders AS DOUBLE), 0)')} AS revenue_per_order,
              CAST(daily_revenue AS DOUBLE) * CAST(0.9 AS DOUBLE) AS revenue_after_tax
            FROM daily WHERE sale_date >= DATE '1997-06-01'"""
    ),
)(lambda t: B.revenue_per_order(t.daily, "1997-06-01"))

query("distinct_months", on_daily(f"SELECT DISTINCT {MONTH} AS month FROM daily"))(lambda t: B.distinct_months(t.daily))

query(
    "filter_or_and",
    on_daily(f"{PLAIN} WHERE (CAST(daily_revenue AS DOUBLE) > {MEAN_DAY} * 1.5 OR num_orders > 9) AND sale_date >= DATE '1996-01-01'"),
)(lambda t: B.either_and(t.daily, t.daily_mean() * 1.5, 9, "1996-01-01"))

query(
    "filter_in_dayname",
    on_daily(
        f"{PLAIN} WHERE {sql_dayname('sale_date')} IN ('Mon', 'Fri') "
        "AND sale_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
    ),
)(lambda t: B.on_weekdays(t.daily, ["Mon", "Fri"], "1996-01-01", "1999-12-31"))

query(
    "filter_not_in",
    on_daily(
        f"{PLAIN} WHERE NOT {sql_dayname('sale_date')} IN ('Sat', 'Sun') "
        "AND sale_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
    ),
)(lambda t: B.on_weekdays(t.daily, ["Sat", "Sun"], "1996-01-01", "1999-12-31", negate=True))

query("filter_like", on_daily(f"{PLAIN} WHERE strftime(sale_date, '%Y-%m') LIKE '1998-0%'"))(
    lambda t: B.month_like(t.daily, "1998-0%")
)

query(
    "filter_between",
    on_daily(f"{PLAIN} WHERE CAST(daily_revenue AS DOUBLE) BETWEEN {MEAN_DAY} * 0.5 AND {MEAN_DAY} * 1.25 AND sale_date >= DATE '1996-01-01'"),
)(lambda t: B.revenue_between(t.daily, t.daily_mean() * 0.5, t.daily_mean() * 1.25, "1996-01-01"))

query(
    "filter_not_null",
    with_sql(
        "part_sales small_parts",
        """SELECT part_id, CAST(amount AS DOUBLE) AS amount, num_lines, p_name AS part_name
           FROM part_sales LEFT JOIN small_parts ON part_id = p_partkey WHERE p_name IS NOT NULL""",
    ),
)(lambda t: B.not_null(J.left_with_orphans(t.part_sales, t.small_parts), "part_name"))

query(
    "case_buckets",
    with_sql(
        "daily_indexed",
        f"""SELECT sale_date, {TIER} AS revenue_tier,
              CASE month(sale_date) WHEN 12 THEN 'WINTER' WHEN 1 THEN 'WINTER' WHEN 2 THEN 'WINTER'
                WHEN 3 THEN 'SPRING' WHEN 4 THEN 'SPRING' WHEN 5 THEN 'SPRING'
                WHEN 6 THEN 'SUMMER' WHEN 7 THEN 'SUMMER' WHEN 8 THEN 'SUMMER' ELSE 'AUTUMN' END AS season
            FROM daily_indexed"""
    ),
)(lambda t: B.buckets(t.daily_indexed))

query(
    "typed_nulls_casts",
    on_daily(
        """SELECT CAST(sale_date AS VARCHAR) AS date_text,
             CAST(floor(CAST(daily_revenue AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS revenue_int,
             CAST(num_orders AS INTEGER) AS orders_int, CAST(NULL AS DOUBLE) AS forecast_revenue,
             CAST(NULL AS DATE) AS forecast_date, CAST(CAST(sale_date AS VARCHAR) AS DATE) AS sale_date FROM daily"""
    ),
)(lambda t: B.casts(t.daily))

query(
    "coalesce_default",
    with_sql(
        "part_sales small_parts",
        """SELECT part_id, CAST(amount AS DOUBLE) AS amount, num_lines, COALESCE(p_name, 'unknown') AS part_name
           FROM part_sales LEFT JOIN small_parts ON part_id = p_partkey""",
    ),
)(lambda t: B.with_default(J.left_with_orphans(t.part_sales, t.small_parts), "part_name", "unknown"))

query(
    "scalar_subquery",
    on_daily(
        f"""SELECT sale_date, {REV}, {sql_r(f"(SELECT {sql_mean('daily_revenue')} FROM daily)")} AS avg_revenue,
              CASE WHEN CAST(daily_revenue AS DOUBLE) > (SELECT {sql_mean('daily_revenue')} FROM daily)
                THEN 'ABOVE' ELSE 'BELOW' END AS position FROM daily"""
    ),
)(lambda t: B.against_mean(t.daily))

# --- joins ----------------------------------------------------------------------------------

query(
    "join_inner",
    with_sql(
        "lines cats",
        f"""SELECT sale_date, category, CAST(category_revenue AS DOUBLE) AS category_revenue,
              {sql_r('CAST(category_revenue AS DOUBLE) * margin_pct')} AS estimated_profit
            FROM lines JOIN cats USING (category)""",
    ),
)(lambda t: J.category_profit(t.lines, t.cats))

query(
    "join_inner_multi",
    with_sql(
        "lines cats",
        """SELECT sale_date, l.category, CAST(category_revenue AS DOUBLE) AS category_revenue
           FROM lines l JOIN cats c ON l.category = c.category AND c.margin_pct >= CAST(0.3 AS DOUBLE)""",
    ),
)(lambda t: J.high_margin(t.lines, t.cats, 0.30))

query(
    "join_left",
    with_sql(
        "part_sales small_parts",
        """SELECT part_id, CAST(amount AS DOUBLE) AS amount, num_lines, p_name AS part_name
           FROM part_sales LEFT JOIN small_parts ON part_id = p_partkey""",
    ),
)(lambda t: J.left_with_orphans(t.part_sales, t.small_parts))

query(
    "join_anti",
    with_sql(
        "part_sales small_parts",
        """SELECT part_id, CAST(amount AS DOUBLE) AS amount, num_lines
           FROM part_sales LEFT JOIN small_parts ON part_id = p_partkey WHERE p_partkey IS NULL""",
    ),
)(lambda t: J.orphans(t.part_sales, t.small_parts))

query(
    "join_right",
    with_sql(
        "part_sales small_parts",
        """SELECT p_partkey, p_name AS part_name, part_id, CAST(amount AS DOUBLE) AS amount
           FROM part_sales RIGHT JOIN small_parts ON part_id = p_partkey""",
    ),
)(lambda t: J.right_all_dim(t.part_sales, t.small_parts))

query(
    "join_full_outer",
    with_sql(
        "part_sales small_parts",
        """SELECT COALESCE(part_id, p_partkey) AS part_key, p_name AS part_name, CAST(amount AS DOUBLE) AS amount
           FROM part_sales FULL JOIN small_parts ON part_id = p_partkey""",
    ),
)(lambda t: J.full_both(t.part_sales, t.small_parts))

query(
    "join_cross_grid",
    with_sql(
        "daily cats",
        "SELECT sale_date, category FROM (SELECT DISTINCT sale_date FROM daily) CROSS JOIN (SELECT DISTINCT category FROM cats)",
    ),
)(lambda t: J.grid(t.daily.select("sale_date"), t.cats.select("category")))

query(
    "join_cross_scalar",
    on_daily(
        f"""SELECT sale_date, {REV}, CAST(min_rev AS DOUBLE) AS min_rev, CAST(max_rev AS DOUBLE) AS max_rev
            FROM daily CROSS JOIN (SELECT MIN(daily_revenue) AS min_rev, MAX(daily_revenue) AS max_rev FROM daily)"""
    ),
)(
    lambda t: J.beside_scalar(
        t.daily.select("sale_date", dbl("daily_revenue").alias("daily_revenue")),
        {"min_rev": F.min("daily_revenue"), "max_rev": F.max("daily_revenue")},
    )
)

query(
    "join_self_prev_day",
    on_daily(
        """SELECT t.sale_date AS today, CAST(t.daily_revenue AS DOUBLE) AS today_rev, y.sale_date AS yesterday,
             CAST(y.daily_revenue AS DOUBLE) AS yesterday_rev,
             CAST(t.daily_revenue - y.daily_revenue AS DOUBLE) AS day_over_day
           FROM daily t JOIN daily y ON t.sale_date = y.sale_date + 1"""
    ),
)(lambda t: J.day_over_day(t.daily))

query(
    "join_multi_table",
    """SELECT p_type AS category, r_name AS region,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS regional_revenue
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)(lambda t: J.regional_revenue(t.lineitem, t.part, t.supplier, t.nation, t.region))

query(
    "join_aggregate",
    with_sql(
        "lines cats",
        f"""SELECT category, margin_pct, COUNT(*) AS num_records, CAST(SUM(category_revenue) AS DOUBLE) AS total_revenue,
              {sql_r(sql_mean('category_revenue'))} AS avg_revenue
            FROM lines JOIN cats USING (category) GROUP BY ALL""",
    ),
)(lambda t: J.category_totals(t.lines, t.cats))

query(
    "join_on_expression",
    on_daily(
        f"""WITH weeks AS (SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
              {sql_r(sql_mean('daily_revenue'))} AS week_avg FROM daily GROUP BY 1)
            SELECT sale_date, {REV}, week_start, week_avg
            FROM daily LEFT JOIN weeks ON CAST(date_trunc('week', sale_date) AS DATE) = week_start"""
    ),
)(lambda t: J.beside_week_mean(t.daily))

query(
    "join_semi_in",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN
         (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-08-01' - 90)""",
)(lambda t: J.active_customers(t.customer, t.orders, "2001-08-01", 90))

query(
    "join_exists",
    """SELECT CAST(f.o_orderdate AS DATE) AS sale_date,
         COUNT(DISTINCT CASE WHEN NOT EXISTS (SELECT 1 FROM orders g WHERE g.o_custkey = f.o_custkey
           AND g.o_orderdate < f.o_orderdate) THEN f.o_custkey END) AS new_customers,
         COUNT(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM orders g WHERE g.o_custkey = f.o_custkey
           AND g.o_orderdate < f.o_orderdate) THEN f.o_custkey END) AS repeat_customers
       FROM orders f GROUP BY 1""",
)(
    lambda t: J.new_and_repeat(
        t.orders.select(F.col("o_orderdate").cast("date").alias("sale_date"), "o_custkey"), "sale_date", "o_custkey"
    )
)

# --- aggregations and reports ---------------------------------------------------------------

AVG = sql_r(sql_mean("daily_revenue"))
AVG_N = sql_r(sql_mean("num_orders"))
SUM = sql_d("SUM(daily_revenue)")
SUM_N = "CAST(SUM(num_orders) AS BIGINT)"
MIN, MAX = sql_d("MIN(daily_revenue)"), sql_d("MAX(daily_revenue)")
STD = sql_r("stddev(CAST(daily_revenue AS DOUBLE))")
PER_ORDER = sql_r("CAST(SUM(daily_revenue) AS DOUBLE) / CAST(SUM(num_orders) AS DOUBLE)")
PER_DAY = sql_r("CAST(SUM(daily_revenue) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)")
YEAR, MON = "CAST(year(sale_date) AS INTEGER)", "CAST(month(sale_date) AS INTEGER)"
QTR, DOW = "CAST(quarter(sale_date) AS INTEGER)", "CAST(dayofweek(sale_date) AS INTEGER)"
WEEKEND = "dayofweek(sale_date) IN (0, 6)"

query(
    "agg_summary",
    on_daily(
        f"""SELECT COUNT(*) AS total_days, MIN(sale_date) AS first_date, MAX(sale_date) AS last_date,
              {AVG} AS avg_daily_revenue, {MIN} AS min_daily_revenue, {MAX} AS max_daily_revenue,
              {SUM_N} AS total_orders, {SUM} AS total_revenue FROM daily"""
    ),
)(lambda t: A.summary(t.daily))

query(
    "agg_monthly",
    on_daily(
        f"""SELECT {MONTH} AS month, {SUM} AS total_revenue, {SUM_N} AS total_orders, {AVG} AS avg_revenue,
              COUNT(*) AS days_in_month FROM daily GROUP BY 1"""
    ),
)(lambda t: A.monthly(t.daily))

query(
    "agg_weekday",
    on_daily(
        f"""SELECT {sql_dayname('sale_date')} AS weekday, {DOW} AS weekday_num, COUNT(*) AS num_days,
              {AVG} AS avg_revenue, {SUM} AS total_revenue FROM daily WHERE sale_date >= DATE '1996-01-01' GROUP BY 1, 2"""
    ),
)(lambda t: A.by_weekday(t.daily, "1996-01-01"))

query(
    "agg_quarter_stats",
    on_daily(
        f"""SELECT {QUARTER} AS quarter, COUNT(*) AS days, {MIN} AS min_rev, {MAX} AS max_rev,
              {sql_r('median(CAST(daily_revenue AS DOUBLE))')} AS median_rev, {STD} AS stddev_rev FROM daily GROUP BY 1"""
    ),
)(lambda t: A.quarter_stats(t.daily))

query(
    "agg_case_tier",
    with_sql(
        "daily_indexed", f"SELECT {TIER} AS revenue_tier, COUNT(*) AS num_days, {AVG} AS avg_rev_in_tier FROM daily_indexed GROUP BY 1"
    ),
)(lambda t: A.by_tier(t.daily_indexed))

HAVING = f"""SELECT {MONTH} AS month, {SUM} AS total_revenue, COUNT(*) AS selling_days, {AVG} AS avg_daily_revenue
             FROM daily {{where}} GROUP BY 1 HAVING {{having}}"""

MEAN_MONTH = f"(SELECT CAST(SUM(daily_revenue) AS DOUBLE) / COUNT(DISTINCT {MONTH}) FROM daily)"


def mean_month(t):
    """Revenue of the mean month, as a scalar subquery."""
    months = F.count_distinct(D.month_start("sale_date"))
    return t.daily.select(F.sum("daily_revenue").cast("double") / months).scalar()


query("having_sum", on_daily(HAVING.format(where="", having=f"CAST(SUM(daily_revenue) AS DOUBLE) > {MEAN_MONTH}")))(
    lambda t: A.months_having(t.daily, F.col("_sum").cast("double") > mean_month(t))
)
query("having_count", on_daily(HAVING.format(where="", having="COUNT(*) > 28")))(
    lambda t: A.months_having(t.daily, F.col("_days") > 28)
)
query("having_avg", on_daily(HAVING.format(where="", having=f"{sql_mean('daily_revenue')} > {MEAN_DAY}")))(
    lambda t: A.months_having(t.daily, F.col("_mean") > t.daily_mean())
)
query(
    "where_group_having",
    on_daily(
        HAVING.format(
            where=f"WHERE sale_date >= DATE '1996-01-01' AND {sql_dayname('sale_date')} NOT IN ('Sat', 'Sun')",
            having=f"{sql_mean('daily_revenue')} > {MEAN_DAY}",
        )
    ),
)(lambda t: A.months_having(t.daily, F.col("_mean") > t.daily_mean(), weekdays_only_since="1996-01-01"))

query(
    "agg_conditional_count",
    on_daily(
        f"""SELECT COUNT(CASE WHEN {WEEKEND} THEN 1 END) AS weekend_days, COUNT(CASE WHEN NOT {WEEKEND} THEN 1 END) AS weekday_days,
              {sql_d(f'SUM(CASE WHEN {WEEKEND} THEN daily_revenue ELSE 0 END)')} AS weekend_revenue,
              {sql_d(f'SUM(CASE WHEN NOT {WEEKEND} THEN daily_revenue ELSE 0 END)')} AS weekday_revenue,
              COUNT(CASE WHEN num_orders > 5 THEN 1 END) AS busy_days FROM daily"""
    ),
)(lambda t: A.conditional_counts(t.daily))

query(
    "agg_count_distinct",
    """SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days,
         COUNT(*) AS num_orders FROM orders GROUP BY 1""",
)(lambda t: A.distinct_counts(t.orders))

query(
    "agg_listagg",
    "SELECT conv_id, string_agg(text, '. ' ORDER BY turn) AS full_text, COUNT(*) AS num_texts FROM conversations GROUP BY 1",
)(lambda t: A.text_per_group(t.conversations, "conv_id", "text", "turn"))

query(
    "agg_array_ordered",
    on_daily(
        f"""SELECT {MONTH} AS month, array_to_string(list(daily_revenue ORDER BY sale_date), ',') AS daily_revenues,
              CAST(COUNT(*) AS INTEGER) AS num_days FROM daily GROUP BY 1"""
    ),
)(
    lambda t: A.values_per_month(t.daily).withColumn(
        "daily_revenues", F.concat_ws(",", F.transform("daily_revenues", lambda x: x.cast("string")))
    )
)

query(
    "silver_monthly",
    on_daily(
        f"""SELECT {MONTH} AS month_date, {YEAR} AS year, {MON} AS month, COUNT(*) AS num_days, {SUM} AS total_revenue,
              {AVG} AS avg_daily_revenue, {MIN} AS min_daily_revenue, {MAX} AS max_daily_revenue,
              {STD} AS stddev_daily_revenue, {SUM_N} AS total_orders, {AVG_N} AS avg_daily_orders,
              {PER_ORDER} AS revenue_per_order FROM daily GROUP BY 1, 2, 3"""
    ),
)(lambda t: A.silver_monthly(t.daily))

query(
    "silver_quarterly",
    on_daily(
        f"""SELECT {YEAR} AS year, {QTR} AS quarter, COUNT(*) AS num_days, {SUM} AS total_revenue, {AVG} AS avg_daily_revenue,
              {PER_DAY} AS avg_revenue, {SUM_N} AS total_orders, {AVG_N} AS avg_daily_orders, {PER_ORDER} AS revenue_per_order,
              {MIN} AS min_revenue, {MAX} AS max_revenue FROM daily GROUP BY 1, 2"""
    ),
)(lambda t: A.silver_quarterly(t.daily))

query(
    "silver_day_analysis",
    on_daily(
        f"""SELECT {sql_dayname('sale_date')} AS day_name, {DOW} AS day_of_week, {WEEKEND} AS is_weekend,
              COUNT(*) AS num_occurrences, {AVG} AS avg_revenue, {SUM} AS total_revenue, {MIN} AS min_revenue,
              {MAX} AS max_revenue, {AVG_N} AS avg_orders, {SUM_N} AS total_orders FROM daily GROUP BY 1, 2, 3"""
    ),
)(lambda t: A.silver_day_analysis(t.daily))

query(
    "gold_agg_monthly",
    on_daily(
        f"""SELECT {YEAR} * 100 + {MON} AS month_key, {MONTH} AS month_date, {YEAR} AS year, {MON} AS month,
              COUNT(*) AS num_days, {SUM} AS total_revenue, {AVG} AS avg_daily_revenue, {STD} AS stddev_daily_revenue,
              {MIN} AS min_daily_revenue, {MAX} AS max_daily_revenue, {SUM_N} AS total_orders, {AVG_N} AS avg_daily_orders,
              {PER_ORDER} AS revenue_per_order, COUNT(CASE WHEN {WEEKEND} THEN 1 END) AS weekend_days,
              COUNT(CASE WHEN NOT {WEEKEND} THEN 1 END) AS weekday_days,
              {sql_d(f'SUM(CASE WHEN {WEEKEND} THEN daily_revenue ELSE 0 END)')} AS weekend_revenue,
              {sql_d(f'SUM(CASE WHEN NOT {WEEKEND} THEN daily_revenue ELSE 0 END)')} AS weekday_revenue
            FROM daily GROUP BY 1, 2, 3, 4"""
    ),
)(lambda t: A.gold_agg_monthly(t.daily))

query(
    "gold_agg_quarterly",
    on_daily(
        f"""SELECT {YEAR} * 10 + {QTR} AS quarter_key, {YEAR} AS year, {QTR} AS quarter, MIN(sale_date) AS quarter_start_date,
              MAX(sale_date) AS quarter_end_date, COUNT(*) AS num_days, {SUM} AS total_revenue, {AVG} AS avg_daily_revenue,
              {PER_DAY} AS avg_revenue, {SUM_N} AS total_orders, {AVG_N} AS avg_daily_orders, {PER_ORDER} AS revenue_per_order,
              {MIN} AS min_daily_revenue, {MAX} AS max_daily_revenue,
              {sql_d('MAX(daily_revenue) - MIN(daily_revenue)')} AS revenue_swing FROM daily GROUP BY 1, 2, 3"""
    ),
)(lambda t: A.gold_agg_quarterly(t.daily))

ODAY = "CAST(o_orderdate AS DATE)"
ODEC = "CAST(o_totalprice AS DECIMAL(18,2))"

query(
    "gold_customer_metrics",
    f"""SELECT c_custkey, c_name, COUNT(DISTINCT o_orderkey) AS total_transactions, COUNT(DISTINCT {ODAY}) AS days_with_purchase,
          CAST(SUM({ODEC}) AS DOUBLE) AS total_revenue,
          {sql_r(f'CAST(SUM({ODEC}) AS DOUBLE) / NULLIF(CAST(COUNT(o_orderkey) AS DOUBLE), 0)')} AS average_order_value,
          CAST(strftime(MAX({ODAY}), '%Y%m%d') AS INTEGER) AS last_purchase_date,
          CAST(strftime(MIN({ODAY}), '%Y%m%d') AS INTEGER) AS first_purchase_date,
          CAST(MAX({ODAY}) - MIN({ODAY}) AS INTEGER) AS customer_lifetime_days
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""",
)(lambda t: A.customer_metrics(t.customer, t.orders))

query(
    "customer_ltv",
    f"""SELECT o_custkey AS customer_id, CAST(SUM({ODEC}) AS DOUBLE) AS lifetime_value,
          COUNT(DISTINCT o_orderkey) AS total_orders FROM orders GROUP BY 1""",
)(lambda t: A.customer_ltv(t.orders))

query(
    "customer_segments",
    f"""WITH spent AS (SELECT o_custkey, SUM({ODEC}) AS ltv FROM orders GROUP BY 1)
        SELECT c_mktsegment AS customer_segment, COUNT(*) AS customer_count, {sql_r(sql_mean('ltv'))} AS avg_ltv
        FROM customer LEFT JOIN spent ON c_custkey = o_custkey GROUP BY 1""",
)(lambda t: A.customer_segments(t.customer, t.orders))

query(
    "report_exploration",
    on_daily(
        f"""SELECT 'Total Records' AS metric, CAST(NULL AS DATE) AS date_dimension, CAST(NULL AS DOUBLE) AS value_numeric,
              CAST(COUNT(*) AS VARCHAR) AS value_text FROM daily
            UNION ALL SELECT 'Date Range', NULL, NULL, CAST(MIN(sale_date) AS VARCHAR) || ' to ' || CAST(MAX(sale_date) AS VARCHAR) FROM daily
            UNION ALL SELECT 'Average Daily Revenue', NULL, {AVG}, NULL FROM daily
            UNION ALL SELECT 'Total Revenue', NULL, {SUM}, NULL FROM daily
            UNION ALL SELECT 'Min Daily Revenue', NULL, {MIN}, NULL FROM daily
            UNION ALL SELECT 'Max Daily Revenue', NULL, {MAX}, NULL FROM daily"""
    ),
)(lambda t: A.exploration(t.daily))

query(
    "report_kpis",
    on_daily(f"SELECT {SUM} AS total_revenue, {AVG} AS avg_daily_revenue, {SUM_N} AS total_orders FROM daily"),
)(lambda t: A.kpis(t.daily))

query(
    "report_explorer",
    on_daily(
        f"""SELECT sale_date, {REV}, num_orders,
              {sql_r('CAST(daily_revenue AS DOUBLE) / NULLIF(CAST(num_orders AS DOUBLE), 0)')} AS rev_per_order
            FROM daily WHERE CAST(daily_revenue AS DOUBLE) >= {MEAN_DAY} * 0.5 AND sale_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""
    ),
)(lambda t: A.explorer(t.daily, t.daily_mean() * 0.5, "1996-01-01", "2000-12-31"))

query(
    "report_seasonality",
    on_daily(
        f"""SELECT 'month' AS kind, CAST(month(sale_date) AS VARCHAR) AS label, {AVG} AS avg_revenue, COUNT(*) AS num_days
            FROM daily GROUP BY 2
            UNION ALL SELECT 'day type', CASE WHEN {WEEKEND} THEN 'weekend' ELSE 'weekday' END, {AVG}, COUNT(*) FROM daily GROUP BY 2"""
    ),
)(lambda t: A.seasonality(t.daily))

query(
    "report_best_worst_month",
    on_daily(
        f"""WITH m AS (SELECT {MONTH} AS month, SUM(daily_revenue) AS r, {SUM_N} AS total_orders, COUNT(*) AS selling_days
              FROM daily GROUP BY 1)
            SELECT * FROM (SELECT 'best' AS which, month, CAST(r AS DOUBLE) AS total_revenue, total_orders, selling_days
              FROM m ORDER BY r DESC, month LIMIT 1)
            UNION ALL SELECT * FROM (SELECT 'worst', month, CAST(r AS DOUBLE), total_orders, selling_days
              FROM m ORDER BY r, month LIMIT 1)"""
    ),
)(lambda t: A.best_and_worst_month(t.daily))

# --- sorts, limits, unions ------------------------------------------------------------------

query(
    "sort_multi",
    on_daily(
        f"""SELECT {MONTH} AS month, sale_date, {REV} FROM daily WHERE sale_date >= DATE '1997-01-01'
            ORDER BY {MONTH}, daily.daily_revenue DESC, sale_date LIMIT 20"""
    ),
)(lambda t: B.sorted_by_month(t.daily, "1997-01-01", 20))

query(
    "sort_position",
    on_daily("SELECT sale_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue, num_orders FROM daily ORDER BY 2 DESC, 1 LIMIT 5"),
)(lambda t: B.sorted_by_position(t.daily, 5))

# Which rows come is not stated, so only their number is checked.
query("limit_preview", "SELECT COUNT(*) AS rows FROM (SELECT * FROM orders LIMIT 10)")(
    lambda t: B.preview(t.orders, 10).agg(F.count(F.lit(1)).alias("rows"))
)

query(
    "sort_nulls_last",
    with_sql(
        "part_sales small_parts",
        """SELECT p_partkey, p_name AS part_name, part_id, CAST(amount AS DOUBLE) AS amount
           FROM part_sales s RIGHT JOIN small_parts ON part_id = p_partkey
           ORDER BY s.amount DESC NULLS LAST, p_partkey""",
    ),
)(
    lambda t: B.sorted_nulls_last(
        J.right_all_dim(t.part_sales, t.small_parts), "amount", "p_partkey"
    )
)

query(
    "set_union_all_periods",
    on_daily(
        """SELECT 'Jan 1999' AS period, CAST(SUM(daily_revenue) AS DOUBLE) AS total_revenue FROM daily
             WHERE sale_date BETWEEN DATE '1999-01-01' AND DATE '1999-01-31'
           UNION ALL SELECT 'Jan 2000', CAST(SUM(daily_revenue) AS DOUBLE) FROM daily
             WHERE sale_date BETWEEN DATE '2000-01-01' AND DATE '2000-01-31'"""
    ),
)(
    lambda t: B.period_totals(
        t.daily, {"Jan 1999": ("1999-01-01", "1999-01-31"), "Jan 2000": ("2000-01-01", "2000-01-31")}
    )
)
