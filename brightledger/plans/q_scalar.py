"""Date, string and number functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import strings as S
from ..operators import calendar as C
from .registry import query
from .relations import sql_dayname, sql_r


def order_days(t):
    """Distinct order days: one row per calendar day."""
    return t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()


DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"

query(
    "date_core",
    f"""SELECT d, d + 30 AS plus_30_days, CAST(d - INTERVAL 3 MONTH AS DATE) AS minus_3_months,
          CAST(date_trunc('month', d) AS DATE) AS start_of_month, {sql_dayname('d')} AS day_name,
          CAST(quarter(d) AS INTEGER) AS quarter, last_day(d) AS end_of_month FROM {DAYS}""",
)(lambda t: C.date_core(order_days(t), "d"))

query(
    "date_add_units",
    """SELECT ts, ts + INTERVAL 12 HOUR AS plus_12_hours, CAST(ts AS DATE) + 14 AS plus_2_weeks,
         CAST(CAST(ts AS DATE) - INTERVAL 1 YEAR AS DATE) AS one_year_ago FROM events""",
)(lambda t: C.date_add_units(t.events, "ts"))

query(
    "date_diff_units",
    """SELECT DISTINCT a, b, CAST(b - a AS INTEGER) AS diff_days,
         CAST((CAST(date_trunc('week', b) AS DATE) - CAST(date_trunc('week', a) AS DATE)) // 7 AS INTEGER) AS diff_weeks,
         CAST((year(b) - year(a)) * 12 + month(b) - month(a) AS INTEGER) AS diff_months,
         CAST(year(b) - year(a) AS INTEGER) AS diff_years
       FROM (SELECT CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b
             FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""",
)(
    lambda t: C.date_diff_units(
        t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(F.col("o_orderdate").cast("date").alias("a"), F.col("l_shipdate").cast("date").alias("b"))
        .distinct(),
        "a", "b",
    )
)

query(
    "ts_diff_units",
    """SELECT event_id, CAST(date_diff('hour', TIMESTAMP '2023-12-31 08:10:00', ts) AS BIGINT) AS hours,
         CAST(date_diff('minute', TIMESTAMP '2023-12-31 08:10:00', ts) AS BIGINT) AS minutes FROM events""",
)(lambda t: C.ts_diff_units(t.events, "event_id", "ts", "2023-12-31 08:10:00"))

query(
    "date_trunc_units",
    """SELECT event_id, date_trunc('second', ts) AS trunc_second, date_trunc('minute', ts) AS trunc_minute,
         date_trunc('hour', ts) AS trunc_hour, CAST(date_trunc('day', ts) AS TIMESTAMP) AS trunc_day,
         CAST(date_trunc('week', ts) AS DATE) AS trunc_week, CAST(date_trunc('month', ts) AS DATE) AS trunc_month,
         CAST(date_trunc('quarter', ts) AS DATE) AS trunc_quarter, CAST(date_trunc('year', ts) AS DATE) AS trunc_year FROM events""",
)(lambda t: C.date_trunc_units(t.events, "event_id", "ts"))

query(
    "date_extract",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS yr, CAST(month(ts) AS INTEGER) AS mo, CAST(day(ts) AS INTEGER) AS dy,
         CAST(hour(ts) AS INTEGER) AS hr, CAST(dayofweek(ts) AS INTEGER) AS day_of_week,
         CAST(dayofyear(ts) AS INTEGER) AS day_of_year, CAST(weekofyear(ts) AS INTEGER) AS week_number,
         CAST(quarter(ts) AS INTEGER) AS quarter FROM events""",
)(lambda t: C.date_extract(t.events, "event_id", "ts"))

query(
    "date_parts_parse_format",
    """SELECT event_id, make_date(year(ts), month(ts), day(ts)) AS built_date,
         make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), 0) AS built_ts,
         CAST(strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed_date,
         date_trunc('second', ts) AS parsed_ts, strftime(ts, '%b %d, %Y') AS formatted_1,
         strftime(ts, '%Y/%m/%d') AS formatted_2, strftime(ts, '%H:%M:%S') AS time_only FROM events""",
)(lambda t: C.date_parts_parse_format(t.events, "event_id", "ts"))

query(
    "date_helpers",
    f"""SELECT d AS day, {sql_dayname('d')} AS day_name, CAST(dayofweek(d) AS INTEGER) AS dow_num,
          CAST(day(d) AS INTEGER) AS dom, CAST(dayofyear(d) AS INTEGER) AS doy, left(monthname(d), 3) AS month_name,
          CAST(weekofyear(d) AS INTEGER) AS week_num, last_day(d) AS end_of_month,
          CAST(date_trunc('week', d) AS DATE) + 6 AS end_of_week, make_date(year(d), 12, 31) AS end_of_year FROM {DAYS}""",
)(lambda t: C.date_helpers(order_days(t).withColumn("day", F.col("d")), "day", "d"))

query(
    "tz_convert",
    # Fixed offsets of January: UTC-3 for Sao Paulo, UTC-5 for New York, UTC+9 for Tokyo.
    """SELECT event_id, ts - INTERVAL 3 HOUR AS sao_paulo, ts - INTERVAL 5 HOUR AS new_york, ts + INTERVAL 9 HOUR AS tokyo
       FROM events""",
)(
    lambda t: C.zones(
        t.events, "event_id", "ts",
        {"sao_paulo": "America/Sao_Paulo", "new_york": "America/New_York", "tokyo": "Asia/Tokyo"},
    )
)

query(
    "date_age_buckets",
    f"""SELECT d, CAST(DATE '2001-08-01' - d AS INTEGER) AS days_ago,
          CAST((CAST(date_trunc('week', DATE '2001-08-01') AS DATE) - CAST(date_trunc('week', d) AS DATE)) // 7 AS INTEGER) AS weeks_ago,
          CAST((2001 - year(d)) * 12 + 8 - month(d) AS INTEGER) AS months_ago,
          CASE WHEN DATE '2001-08-01' - d <= 30 THEN 'RECENT' WHEN DATE '2001-08-01' - d <= 90 THEN 'THIS QUARTER'
            WHEN DATE '2001-08-01' - d <= 365 THEN 'THIS YEAR' ELSE 'OLDER' END AS age_bucket FROM {DAYS}""",
)(lambda t: C.ages(order_days(t), "d", "2001-08-01"))

query(
    "date_keys",
    f"""SELECT d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(strftime(d, '%Y%m') AS INTEGER) AS month_key,
          CAST(year(d) * 10 + quarter(d) AS INTEGER) AS quarter_key, d AS back FROM {DAYS}""",
)(lambda t: C.integer_keys(order_days(t), "d"))


def _calendar(t):
    """Every day from the first of January of the first order year to the last December day."""
    span = t.orders.agg(
        F.trunc(F.min("o_orderdate"), "YEAR").alias("lo"),
        F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("hi"),
    )
    return C.date_spine(t.spark, F.col("lo"), F.datediff("hi", "lo") + 1, span, "date")


def _holidays(t):
    """New Year and Christmas of every year with orders."""
    years = t.orders.select(F.year("o_orderdate").alias("y")).distinct()
    both = F.array(F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(25)))
    return years.select(F.explode(both).alias("h"))


query(
    "dim_date",
    f"""WITH span AS (SELECT make_date(year(MIN(o_orderdate)), 1, 1) AS lo, make_date(year(MAX(o_orderdate)), 12, 31) AS hi FROM orders),
          cal AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date, CAST(year(d) AS INTEGER) AS year,
          CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
          CAST(dayofweek(d) AS INTEGER) AS day_of_week, CAST(isodow(d) AS INTEGER) AS iso_day_of_week,
          CAST(weekofyear(d) AS INTEGER) AS week_of_year, {sql_dayname('d')} AS day_name, left(monthname(d), 3) AS month_name,
          isodow(d) < 6 AS is_weekday,
          (month(d) = 1 AND day(d) = 1 OR month(d) = 12 AND day(d) = 25)
            AND year(d) IN (SELECT year(o_orderdate) FROM orders) AS is_holiday
        FROM cal""",
)(lambda t: C.describe_days(_calendar(t), "date", _holidays(t)))

# --- strings and numbers --------------------------------------------------------------------

# Planted dirt: padding, mixed case and a mail address with and without a dot.
CONTACT_SQL = """(SELECT c_custkey, '  ' || lower(c_name) || ' ' AS id, ' ' || c_name AS name,
  CASE WHEN c_custkey % 9 = 0 THEN 'User' || c_custkey || '@Nowhere' ELSE ' User' || c_custkey || '@Shop' || c_nationkey || '.COM ' END AS email
  FROM customer)"""


def contacts(t):
    """Customers with planted dirt: padding, mixed case, and mail addresses without a dot."""
    key = F.col("c_custkey").cast("string")
    return t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("id"),
        F.concat(F.lit(" "), "c_name").alias("name"),
        F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit("User"), key, F.lit("@Nowhere")))
        .otherwise(F.concat(F.lit(" User"), key, F.lit("@Shop"), F.col("c_nationkey").cast("string"), F.lit(".COM ")))
        .alias("email"),
    )


query(
    "str_clean",
    f"""SELECT c_custkey, trim(upper(id)) AS customer_id, trim(name) AS customer_name, lower(trim(email)) AS email,
          email LIKE '%@%.%' AS is_valid_email FROM {CONTACT_SQL}""",
)(
    lambda t: contacts(t).select(
        "c_custkey",
        S.clean_key("id").alias("customer_id"),
        F.trim("name").alias("customer_name"),
        S.clean_email("email").alias("email"),
        S.looks_like_email("email").alias("is_valid_email"),
    )
)

query(
    "str_build",
    "SELECT doc_id, left(text, 50) || '...' AS preview, repeat('  ', CAST(doc_id % 5 AS INTEGER)) || lang AS indented FROM documents",
)(
    lambda t: t.documents.select(
        "doc_id",
        S.preview("text", 50).alias("preview"),
        S.indent("lang", (F.col("doc_id") % 5).cast("int")).alias("indented"),
    )
)

query(
    "num_functions",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {sql_r('l_extendedprice / NULLIF(l_quantity, 0)')} AS unit_price,
          abs(l_extendedprice - 50000) AS distance, greatest(l_extendedprice, 10000) AS floored,
          1 / NULLIF(l_discount, 0) AS inverse_discount FROM lineitem""",
)(
    lambda t: t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        S.rounded_ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        F.abs(F.col("l_extendedprice") - 50000).alias("distance"),
        F.greatest("l_extendedprice", F.lit(10000.0)).alias("floored"),
        (F.lit(1.0) / F.nullif(F.col("l_discount"), F.lit(0.0))).alias("inverse_discount"),
    )
)

query("num_random", "SELECT o_orderkey, TRUE AS in_range FROM orders")(
    # A seeded draw per order; repeatable for one layout of the input only, so its range is what is checked.
    lambda t: t.orders.select("o_orderkey", F.uniform(F.lit(15.0), F.lit(35.0), F.lit(42)).alias("draw")).select(
        "o_orderkey", F.col("draw").between(15.0, 35.0).alias("in_range")
    )
)
