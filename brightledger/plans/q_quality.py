"""Quality checks, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import dbl
from ..operators import aggregates as A
from ..operators import quality as Q
from ..operators import scd, star
from ..session import scratch_path
from .q_relational import MONTH, REV, on_daily
from .q_scalar import CONTACT_SQL, contacts
from .q_windows import MTD_SQL, YOY_PCT, ZSCORE_SQL
from .registry import query
from .relations import sql_d, sql_dayname, sql_mean, sql_r, with_sql

# --- silver and gold tables -----------------------------------------------------------------


def raw_customers(t):
    """Three loads of the contacts: an older copy of every fifth, and a newer name for every eighth customer."""
    now = contacts(t).select("c_custkey", "id", "name", "email", F.lit("2024-06-02").cast("date").alias("_load_date"))
    older = now.where("c_custkey % 5 = 0").withColumns(
        {"name": F.concat(F.lit("old "), "name"), "_load_date": F.lit("2024-06-01").cast("date")}
    )
    newer = now.where("c_custkey % 8 = 0").withColumns(
        {"name": F.concat("name", F.lit(" Jr")), "_load_date": F.lit("2024-06-03").cast("date"), "id": F.upper("id")}
    )
    return older.unionByName(now).unionByName(newer).drop("c_custkey")


SILVER_CUSTOMER = f"""SELECT trim(upper(id)) AS customer_id,
  CASE WHEN c_custkey % 8 = 0 THEN trim(name || ' Jr') ELSE trim(name) END AS customer_name,
  lower(trim(email)) AS email, email LIKE '%@%.%' AS is_valid_email, TRUE AS is_active,
  DATE '2024-06-03' AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM {CONTACT_SQL}"""

query("silver_customer", SILVER_CUSTOMER)(lambda t: scd.silver_customer(raw_customers(t), "2024-06-03"))


def dim_v1(t):
    """The first state of the customer dimension."""
    return t.customer.select(
        "c_custkey", "c_name", "c_mktsegment",
        F.lit("2024-01-01").cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )


def dim_v2(t):
    return scd.scd2_merge(dim_v1(t), t.customer_v2, ["c_custkey"], ["c_name", "c_mktsegment"], "2024-06-01", unique=True)


SCD2 = with_sql(
    "customer_v2",
    """SELECT c.c_custkey, c.c_name, c.c_mktsegment, DATE '2024-01-01' AS effective_date,
         CASE WHEN n.c_custkey IS NOT NULL AND n.c_mktsegment <> c.c_mktsegment THEN DATE '2024-05-31' END AS end_date,
         n.c_custkey IS NULL OR n.c_mktsegment = c.c_mktsegment AS is_current
       FROM customer c LEFT JOIN customer_v2 n ON c.c_custkey = n.c_custkey
       UNION ALL
       SELECT n.c_custkey, n.c_name, n.c_mktsegment, DATE '2024-06-01', NULL, TRUE
       FROM customer_v2 n LEFT JOIN customer c ON c.c_custkey = n.c_custkey
       WHERE c.c_custkey IS NULL OR n.c_mktsegment <> c.c_mktsegment""",
)

query("scd2_merge", SCD2)(dim_v2)


def _dim_stored(t):
    """The same dimension as a stored table, after two merges."""
    table = scd.Scd2Table(
        t.spark, scratch_path(t.spark, "dimension"), "c_custkey bigint, c_name string, c_mktsegment string", ["c_custkey"], ["c_name", "c_mktsegment"], buckets=16
    )
    table.merge(t.customer, "2024-01-01")
    table.merge(t.customer_v2, "2024-06-01")
    return table.read()


query("scd2_merge_stored", SCD2)(_dim_stored)
query("scd2_read", f"SELECT * FROM ({SCD2}) WHERE is_current")(lambda t: scd.scd2_current(dim_v2(t)))

ROUND_Z = sql_r(ZSCORE_SQL, 6)
FEATURES = f"""CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
  CAST(quarter(sale_date) AS INTEGER) AS quarter, CAST(dayofweek(sale_date) AS INTEGER) AS day_of_week,
  CAST(weekofyear(sale_date) AS INTEGER) AS week_of_year,
  {sql_r('CAST(daily.daily_revenue AS DOUBLE) / NULLIF(CAST(daily.num_orders AS DOUBLE), 0)')} AS revenue_per_order,
  dayofweek(sale_date) IN (0, 6) AS is_weekend, month(sale_date) IN (11, 12) AS is_holiday_season"""

query(
    "silver_daily_sales",
    on_daily(
        f"""SELECT sale_date, {REV}, num_orders, {FEATURES}, {sql_dayname('sale_date')} AS day_name, {ROUND_Z} AS revenue_zscore
            FROM daily WHERE daily.daily_revenue > 0 AND num_orders > 0"""
    ),
)(
    lambda t: star.silver_daily_sales(t.daily)
    .withColumn("daily_revenue", dbl("daily_revenue"))
    .withColumn("revenue_zscore", F.floor(F.col("revenue_zscore") * 1e6 + 0.5) / 1e6)
)

ROLL = "SUM(daily.daily_revenue) OVER (ORDER BY sale_date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
query(
    "gold_fact_daily",
    on_daily(
        f"""WITH f AS (SELECT CAST(strftime(sale_date, '%Y%m%d') AS INTEGER) AS date_key, sale_date, num_orders, {FEATURES},
              {sql_d(ROLL.format(n=6))} AS revenue_7day_rolling, {sql_d(ROLL.format(n=29))} AS revenue_30day_rolling,
              {MTD_SQL} AS revenue_month_to_date FROM daily WHERE daily_revenue > 0 AND num_orders > 0)
            SELECT f.*, CAST(c.daily_revenue AS DOUBLE) AS daily_revenue, CAST(p.daily_revenue AS DOUBLE) AS revenue_yoy_prior,
              {YOY_PCT} AS revenue_yoy_pct_change
            FROM f JOIN daily c USING (sale_date) LEFT JOIN daily p ON p.sale_date = CAST(f.sale_date - INTERVAL 1 YEAR AS DATE)"""
    ),
)(lambda t: star.gold_fact_daily(star.silver_daily_sales(t.daily)).withColumn("daily_revenue", dbl("daily_revenue")))

FACT = """fact AS (SELECT customer_id, product_id, date_id, quantity, unit_price, total_amount, discount_amount,
    ROUND((total_amount - discount_amount) * tax, 2) AS tax_amount,
    CAST(total_amount - discount_amount + ROUND((total_amount - discount_amount) * tax, 2) AS DECIMAL(18,2)) AS net_amount,
    is_return, is_cancelled, transaction_id
  FROM (SELECT o_custkey AS customer_id, l_partkey AS product_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
      CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
      CAST(l_extendedprice AS DECIMAL(14,2)) AS total_amount,
      ROUND(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS discount_amount,
      CAST(l_tax AS DECIMAL(4,2)) AS tax, l_returnflag = 'R' AS is_return,
      o_orderstatus = 'P' AND l_linestatus = 'F' AS is_cancelled, l_orderkey || '-' || l_linenumber AS transaction_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey))"""


def fact_sales(t):
    return star.gold_fact_sales(t.lineitem, t.orders, t.part)


AMOUNTS = ["unit_price", "total_amount", "discount_amount", "tax_amount", "net_amount"]
query(
    "gold_fact_sales",
    f"WITH {FACT} SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in AMOUNTS)}) FROM fact",
)(lambda t: fact_sales(t).withColumns({c: dbl(c) for c in AMOUNTS}))

def _daily_totals(t):
    """The totals read their fact three times, so the fact is written first, as the pipeline does."""
    path = scratch_path(t.spark, "fact")
    used = ["date_id", "customer_id", "product_id", "quantity", "net_amount", "is_cancelled"]
    fact_sales(t).select(*used).write.parquet(path)
    return star.gold_agg_daily_sales(t.spark.read.parquet(path))


query(
    "gold_agg_daily_sales",
    f"""WITH {FACT}, firsts AS (SELECT customer_id, MIN(date_id) AS first_id FROM fact GROUP BY 1), last AS (SELECT MAX(date_id) AS m FROM fact)
        SELECT date_id, customer_id, product_id, CAST(SUM(net_amount) AS DOUBLE) AS total_sales,
          CAST(SUM(quantity) AS BIGINT) AS total_quantity, COUNT(*) AS transaction_count,
          {sql_r('CAST(SUM(net_amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)')} AS average_transaction_value,
          CAST(COUNT(DISTINCT CASE WHEN date_id = m AND first_id = date_id THEN customer_id END) AS INTEGER) AS new_customers,
          CAST(COUNT(DISTINCT CASE WHEN date_id = m AND first_id < date_id THEN customer_id END) AS INTEGER) AS repeat_customers
        FROM fact JOIN firsts USING (customer_id) CROSS JOIN last WHERE NOT is_cancelled GROUP BY 1, 2, 3""",
)(_daily_totals)

query(
    "gold_dim_product",
    """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
         p_retailprice AS unit_price, p_size > 0 AS is_active,
         CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS product_key FROM part""",
)(lambda t: star.gold_dim_product(t.part))

# --- checks ---------------------------------------------------------------------------------

query(
    "dq_duplicates",
    """SELECT user_id, event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
)(
    lambda t: Q.duplicates(
        t.events.select("user_id", "event_type", F.col("ts").cast("date").alias("day")), ["user_id", "event_type", "day"]
    )
)

HOLED_ORDERS = """(SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority FROM orders)"""
NULL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def holed_orders(t):
    """Orders with planted NULLs: every 50th customer, and the priority of unfinished orders."""
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("o_orderpriority"),
    )


query(
    "dq_nulls",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, COUNT(*) AS total_rows FROM {HOLED_ORDERS}"
        for c in NULL_COLS
    ),
)(lambda t: Q.null_counts(holed_orders(t)))

query(
    "dq_gaps",
    on_daily(
        """SELECT COUNT(DISTINCT sale_date) AS distinct_dates, COUNT(*) AS total_rows,
             CAST(MAX(sale_date) - MIN(sale_date) + 1 AS INTEGER) AS expected_days,
             CASE WHEN COUNT(*) = MAX(sale_date) - MIN(sale_date) + 1 THEN 'PASS: No gaps in data'
               ELSE 'FAIL: Data gaps detected' END AS gap_check FROM daily"""
    ),
)(lambda t: Q.gaps(t.daily, "sale_date"))

query(
    "dq_positive",
    on_daily(
        """SELECT COUNT(*) AS total_rows, COUNT(CASE WHEN daily_revenue > 0 THEN 1 END) AS positive_revenue,
             COUNT(CASE WHEN daily_revenue <= 0 THEN 1 END) AS non_positive_revenue,
             CASE WHEN COUNT(CASE WHEN daily_revenue > 0 THEN 1 END) = COUNT(*) THEN 'PASS: All revenue positive'
               ELSE 'FAIL: Negative or zero revenue found' END AS revenue_check FROM daily"""
    ),
)(lambda t: Q.positive(t.daily, "daily_revenue"))

query(
    "dq_silver_status",
    f"""WITH s AS ({SILVER_CUSTOMER}),
          q AS (SELECT COUNT(*) AS total_records, COUNT(*) - COUNT(customer_id) AS null_ids, COUNT(*) - COUNT(customer_name) AS null_names,
            COUNT(CASE WHEN NOT is_valid_email THEN 1 END) AS invalid_emails, COUNT(DISTINCT customer_id) AS unique_customers
            FROM s WHERE is_current)
        SELECT *, CASE WHEN null_ids = 0 AND null_names = 0 AND invalid_emails < total_records * 0.05 THEN 'PASSED' ELSE 'FAILED' END AS quality_status
        FROM q""",
)(lambda t: Q.silver_status(scd.silver_customer(raw_customers(t), "2024-06-03")))

query(
    "dq_outliers",
    on_daily(
        f"""WITH z AS (SELECT *, {ZSCORE_SQL} AS z FROM daily)
            SELECT COUNT(*) AS total_records, COUNT(DISTINCT sale_date) AS distinct_dates, MIN(sale_date) AS earliest_date,
              MAX(sale_date) AS latest_date, {sql_r(sql_mean('daily_revenue'))} AS avg_revenue,
              {sql_r('stddev(CAST(daily_revenue AS DOUBLE))')} AS stddev_revenue, COUNT(CASE WHEN z > 3 THEN 1 END) AS outlier_count,
              {sql_r('CAST(COUNT(CASE WHEN z > 3 THEN 1 END) * 100 AS DOUBLE) / COUNT(*)')} AS outlier_pct FROM z"""
    ),
)(lambda t: Q.outliers(t.daily))

query(
    "dq_ref_integrity",
    with_sql(
        "customer_v2 small_parts",
        """SELECT 'Missing Customer' AS issue, COUNT(*) AS count FROM orders LEFT JOIN customer_v2 ON o_custkey = c_custkey WHERE c_custkey IS NULL
           UNION ALL SELECT 'Missing Product', COUNT(*) FROM lineitem LEFT JOIN small_parts ON l_partkey = p_partkey WHERE p_partkey IS NULL""",
    ),
)(
    lambda t: Q.missing_references(
        {
            "Missing Customer": (t.orders, "o_custkey", t.customer_v2, "c_custkey"),
            "Missing Product": (t.lineitem, "l_partkey", t.small_parts, "p_partkey"),
        }
    )
)

query(
    "dq_measures",
    f"""WITH {FACT} SELECT COUNT(CASE WHEN net_amount <> total_amount - discount_amount + tax_amount THEN 1 END) AS amount_calc_errors,
          COUNT(CASE WHEN total_amount <> quantity * unit_price THEN 1 END) AS total_calc_errors FROM fact""",
)(lambda t: Q.measure_errors(fact_sales(t)))

query(
    "dq_fact_consistency",
    on_daily(
        """SELECT 'gold_fact_daily_sales consistency' AS check_name, COUNT(DISTINCT strftime(sale_date, '%Y%m%d')) AS distinct_date_keys,
             COUNT(DISTINCT sale_date) AS distinct_dates,
             CASE WHEN COUNT(DISTINCT strftime(sale_date, '%Y%m%d')) = COUNT(DISTINCT sale_date) THEN 'PASS' ELSE 'FAIL' END AS status FROM daily"""
    ),
)(
    lambda t: Q.key_consistency(
        star.gold_fact_daily(star.silver_daily_sales(t.daily)), "date_key", "sale_date", "gold_fact_daily_sales consistency"
    )
)

query(
    "dq_agg_complete",
    on_daily(
        f"""SELECT 'Monthly aggregates completeness' AS check_name, COUNT(DISTINCT {MONTH}) AS aggregated_months,
              COUNT(DISTINCT {MONTH}) AS expected_months, 'PASS' AS status FROM daily"""
    ),
)(lambda t: Q.months_complete(A.gold_agg_monthly(t.daily), "month_date", t.daily, "sale_date"))

query(
    "dq_profile",
    with_sql(
        "customer_v2",
        f"""WITH p AS (SELECT COUNT(*) AS prev FROM customer), c AS (SELECT COUNT(*) AS n,
              COUNT(*) * 5 - COUNT(c_custkey) - COUNT(c_name) - COUNT(c_nationkey) - COUNT(c_acctbal) - COUNT(c_mktsegment) AS nulls,
              COUNT(*) - COUNT(DISTINCT c_name) AS dups FROM customer_v2)
            SELECT 'customer' AS table_name, n AS row_count, {sql_r('CAST((n - prev) * 100 AS DOUBLE) / prev')} AS growth_pct,
              {sql_r('CAST(nulls * 100 AS DOUBLE) / (n * 5)')} AS null_pct, {sql_r('CAST(dups * 100 AS DOUBLE) / n')} AS duplicate_pct
            FROM c CROSS JOIN p""",
    ),
)(lambda t: Q.profile(t.customer_v2, "customer", ["c_name"], t.customer.select(F.count(F.lit(1))).scalar()))

query(
    "dq_row_hash",
    """SELECT COUNT(*) + COUNT(CASE WHEN c_custkey % 17 = 0 THEN 1 END) AS total_rows, COUNT(*) AS distinct_rows,
         COUNT(CASE WHEN c_custkey % 17 = 0 THEN 1 END) AS duplicate_rows FROM customer""",
)(
    # Every 17th row is planted a second time.
    lambda t: Q.repeated_rows(t.customer.unionByName(t.customer.where("c_custkey % 17 = 0")))
)

query(
    "dq_freshness",
    """SELECT CAST(MAX(ts) AS DATE) AS last_load, CASE WHEN CAST(MAX(ts) AS DATE) < DATE '2024-02-15'
         THEN 'ALERT: No data loaded today' ELSE 'OK' END AS status FROM events""",
)(lambda t: Q.freshness(t.events, "ts", "2024-02-15"))


def _rules_sql(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", COUNT(CASE WHEN {bad} THEN 1 END) = 0 AS passed, COUNT(CASE WHEN {bad} THEN 1 END) AS failed_rows FROM {source}"
        for n, bad in rules.items()
    )


RAW_SQL = _rules_sql(
    "orders",
    {
        "id present": "o_orderkey IS NULL",
        "amount positive": "NOT o_totalprice > 0",
        "status allowed": "o_orderstatus NOT IN ('P', 'F', 'O')",
    },
)
query("dq_raw_rules", RAW_SQL)(
    lambda t: Q.run_rules(t.orders, Q.raw_rules("o_orderkey", "o_totalprice", "o_orderstatus"))
)


def order_lines(t):
    """Order lines with a final amount; every 50th line of a supplier key has it wrong by a cent."""
    line, pct = F.col("l_extendedprice").cast("decimal(14,2)"), (F.col("l_discount") * 100).cast("decimal(5,2)")
    off = F.when(F.col("l_partkey") % 50 == 0, F.lit(0.01)).otherwise(F.lit(0)).cast("decimal(3,2)")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        line.alias("unit_price"), line.alias("line_amount"), pct.alias("discount_percent"),
        (F.round(line * (1 - pct / 100), 2) + off).alias("final_amount"),
        (F.col("l_returnflag") == "R").alias("is_return"),
        (F.col("l_linestatus") == "F").alias("is_cancelled"),
    )


query(
    "dq_order_rules",
    """SELECT 'unique line id' AS "check", COUNT(*) = COUNT(DISTINCT (l_orderkey, l_linenumber)) AS passed,
         COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS failed_rows FROM lineitem UNION ALL """
    + _rules_sql(
        "lineitem",
        {
            "quantity not negative": "l_quantity < 0",
            "unit price not negative": "l_extendedprice < 0",
            "final amount follows": "l_partkey % 50 = 0",
            "not returned and cancelled": "l_returnflag = 'R' AND l_linestatus = 'F'",
        },
    ),
)(lambda t: Q.order_rules(order_lines(t), ["l_orderkey", "l_linenumber"]))

_SCD_SQL = f"""WITH d AS (SELECT *, lead(effective_date) OVER (PARTITION BY c_custkey ORDER BY effective_date) AS nxt FROM ({SCD2})),
  f AS (SELECT 'unique version' AS name, COUNT(*) - COUNT(DISTINCT (c_custkey, effective_date)) AS n FROM d
    UNION ALL SELECT 'no overlap', COUNT(CASE WHEN nxt IS NOT NULL AND (end_date IS NULL OR end_date >= nxt) THEN 1 END) FROM d
    UNION ALL SELECT 'current means open', COUNT(CASE WHEN is_current <> (end_date IS NULL) THEN 1 END) FROM d)
  SELECT name AS "check", n = 0 AS passed, n AS failed_rows FROM f"""

query("dq_scd_rules", _SCD_SQL)(lambda t: Q.scd_rules(dim_v2(t), "c_custkey"))

query(
    "dq_not_null",
    _rules_sql(HOLED_ORDERS, {"o_custkey": "o_custkey IS NULL", "o_orderkey": "o_orderkey IS NULL"}),
)(
    lambda t: Q.run_rules(
        holed_orders(t), {"o_custkey": F.col("o_custkey").isNotNull(), "o_orderkey": F.col("o_orderkey").isNotNull()}
    )
)

query(
    "dq_types",
    _rules_sql("orders", {"o_orderkey": "FALSE", "o_totalprice": "o_orderkey % 97 = 0", "o_orderdate": "FALSE"}),
)(
    # Text copies of three columns; every 97th price is not a number.
    lambda t: Q.failed_casts(
        t.orders.select(
            F.col("o_orderkey").cast("string").alias("o_orderkey"),
            F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
            F.col("o_orderdate").cast("string").alias("o_orderdate"),
        ),
        {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "timestamp_ntz"},
    )
)

query(
    "dq_row_count",
    """SELECT 'orders' AS "table", COUNT(*) AS rows, COUNT(*) >= 100 AS above_minimum, COUNT(*) <= 1000 AS below_maximum FROM orders""",
)(lambda t: Q.row_count_rule(t.orders, "orders", 100, 1000))

query(
    "dq_no_duplicates",
    """SELECT 'unique (l_orderkey, l_linenumber)' AS "check", COUNT(*) = COUNT(DISTINCT (l_orderkey, l_linenumber)) AS passed,
         COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS failed_rows FROM lineitem""",
)(lambda t: Q.unique_rule(t.lineitem, "unique (l_orderkey, l_linenumber)", ["l_orderkey", "l_linenumber"]))

query(
    "dq_allowed_values",
    "SELECT o_orderstatus, COUNT(*) AS rows FROM orders WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderstatus IS NULL GROUP BY 1",
)(lambda t: Q.invalid_values(t.orders, "o_orderstatus", ["F", "O"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows")))

query(
    "dq_report",
    f"""WITH c AS ({RAW_SQL} UNION ALL SELECT 'few customers', COUNT(CASE WHEN o_custkey > 10 THEN 1 END) = 0, 0 FROM orders)
        SELECT 'orders' AS "table", COUNT(*) AS total_checks, COUNT(CASE WHEN passed THEN 1 END) AS passed_checks,
          COUNT(CASE WHEN NOT passed THEN 1 END) AS failed_checks,
          {sql_r('CAST(COUNT(CASE WHEN passed THEN 1 END) * 100 AS DOUBLE) / COUNT(*)')} AS success_rate FROM c""",
)(
    lambda t: Q.report(
        Q.run_rules(
            t.orders,
            {**Q.raw_rules("o_orderkey", "o_totalprice", "o_orderstatus"), "few customers": F.col("o_custkey") <= 10},
        ),
        "orders",
    )
)
