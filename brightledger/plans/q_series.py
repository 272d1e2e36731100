"""Forecasts, anomalies and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import cents, dbl, money, r2
from ..operators import learning as L
from ..operators import series as S
from ..operators.basics import revenue_tier
from ..operators.layout import stored
from ..session import scratch_path
from ..sources import writers
from .q_relational import on_daily
from .registry import query
from .relations import sql_r, with_sql

X = "(d - DATE '2000-01-01')"


def fit_sql(source: str, key: str = "") -> str:
    """The additive model over ``source(key, d, v)`` as common table expressions ending in ``model`` and ``effects``."""
    k = f"{key}, " if key else ""
    by = f"PARTITION BY {key}" if key else ""
    bym, byw = (f"PARTITION BY {k}m", f"PARTITION BY {k}w")
    steps = [
        f"""cells AS (SELECT {k}month(d) AS m, dayofweek(d) AS w, CAST(COUNT(*) AS DOUBLE) AS n,
              CAST(SUM(CAST({X} AS BIGINT)) AS DOUBLE) AS sx, CAST(SUM(CAST({X} AS BIGINT) * {X}) AS DOUBLE) AS sxx,
              CAST(SUM(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS sy,
              CAST(SUM(CAST({X} AS DECIMAL(19,0)) * CAST(v AS DECIMAL(19,2))) AS DOUBLE) AS sxy,
              CAST(SUM(CAST(v AS DECIMAL(19,2)) * CAST(v AS DECIMAL(19,2))) AS DOUBLE) AS syy, MAX(d) AS last
            FROM {source} GROUP BY ALL)""",
        f"""f0 AS (SELECT *, SUM(sxy - sx * sy / n) OVER ({by}) / SUM(sxx - sx * sx / n) OVER ({by}) AS slope FROM cells)""",
        f"""f1 AS (SELECT *, SUM(sy - slope * sx) OVER ({by}) / SUM(n) OVER ({by}) AS level FROM f0)""",
        """p0 AS (SELECT *, sy - slope * sx - n * level AS res, CAST(0 AS DOUBLE) AS b FROM f1)""",
    ]
    for i in (1, 2, 3):
        steps.append(
            f"q{i} AS (SELECT * {'EXCLUDE (a) ' if i > 1 else ''}, SUM(res - n * b) OVER ({bym}) / SUM(n) OVER ({bym}) AS a FROM p{i - 1})"
        )
        steps.append(f"p{i} AS (SELECT * EXCLUDE (b), SUM(res - n * a) OVER ({byw}) / SUM(n) OVER ({byw}) AS b FROM q{i})")
    steps.append(
        f"""model AS (SELECT {k}ANY_VALUE(slope) AS slope, ANY_VALUE(level) AS level, MAX(last) AS last_date,
              sqrt(greatest(SUM(syy - 2 * slope * sxy + slope * slope * sxx - 2 * (level + a + b) * (sy - slope * sx)
                + n * (level + a + b) * (level + a + b)), 0) / (SUM(n) - 1)) AS sigma
            FROM p3 {f'GROUP BY {key}' if key else ''})"""
    )
    steps.append(f"em AS (SELECT DISTINCT {k}m, a FROM p3)")
    steps.append(f"ew AS (SELECT DISTINCT {k}w, b FROM p3)")
    return ",\n".join(steps)


DAILY_V = "series AS (SELECT sale_date AS d, daily_revenue AS v FROM daily)"
POINT = f"level + slope * {X} + COALESCE(a, 0) + COALESCE(b, 0)"


def forecast_sql(days: int, interval: float = 0.95) -> str:
    z = repr(S.quantile(interval))
    return f"""WITH {DAILY_V}, {fit_sql('series')},
      ahead AS (SELECT *, CAST(last_date + CAST(i AS INTEGER) AS DATE) AS d FROM (SELECT *, UNNEST(generate_series(1, {days})) AS i FROM model)),
      fc AS (SELECT d, {POINT} AS point, CAST({z} AS DOUBLE) * sigma AS half
        FROM ahead LEFT JOIN em ON em.m = month(d) LEFT JOIN ew ON ew.w = dayofweek(d)),
      tab AS (SELECT d AS forecast_date, {sql_r('point')} AS forecasted_revenue, {sql_r('point - half')} AS lower_bound_95pct,
        {sql_r('point + half')} AS upper_bound_95pct, {sql_r('(point + half) - (point - half)')} AS confidence_interval_width FROM fc)
    """


def forecast(t, days):
    return S.forecast_table(S.ts_fit(t.daily, "sale_date", "daily_revenue"), days)


def combined(t, days=90):
    """Actual and forecast days, from daily totals that are made once."""
    daily = stored(t.daily, "daily")
    return S.combined(daily, S.forecast_table(S.ts_fit(daily, "sale_date", "daily_revenue"), days))


query(
    "ts_forecast",
    on_daily(
        forecast_sql(30, 0.85)
        + "SELECT forecast_date AS ts, forecasted_revenue AS forecast, lower_bound_95pct AS lower_bound, upper_bound_95pct AS upper_bound FROM tab"
    ),
)(
    lambda t: S.ts_forecast(S.ts_fit(t.daily, "sale_date", "daily_revenue"), 30, 0.85).select(
        "ts", r2("forecast").alias("forecast"), r2("lower_bound").alias("lower_bound"), r2("upper_bound").alias("upper_bound")
    )
)

query(
    "ts_evaluate",
    on_daily(
        f"""WITH allrows AS (SELECT sale_date AS d, daily_revenue AS v FROM daily), edge AS (SELECT MAX(d) - 90 AS e FROM allrows),
              series AS (SELECT d, v FROM allrows, edge WHERE d <= e), {fit_sql('series')},
              s AS (SELECT CAST(v AS DOUBLE) AS actual, {POINT} AS f, CAST({S.quantile(0.95)!r} AS DOUBLE) * sigma AS half
                FROM allrows CROSS JOIN edge CROSS JOIN model LEFT JOIN em ON em.m = month(d) LEFT JOIN ew ON ew.w = dayofweek(d) WHERE d > e)
            SELECT COUNT(*) AS n, {sql_r('SUM(abs((actual - f) / NULLIF(actual, 0))) / COUNT(*) * 100', 4)} AS mape,
              {sql_r('SUM(abs(actual - f)) / COUNT(*)')} AS mae, round(SUM((actual - f) * (actual - f)) / COUNT(*), 0) AS mse,
              {sql_r('sqrt(SUM((actual - f) * (actual - f)) / COUNT(*))')} AS rmse,
              {sql_r('CAST(COUNT(CASE WHEN actual BETWEEN f - half AND f + half THEN 1 END) * 100 AS DOUBLE) / COUNT(*)')} AS coverage FROM s"""
    ),
)(lambda t: S.ts_evaluate(t.daily, "sale_date", "daily_revenue", 90))

def _folds(t):
    return S.ts_backtest(t.daily, "sale_date", "daily_revenue", 90, 3)


def _fold_sql(k: int) -> str:
    """The evaluation of fold k of 3, from its own model."""
    return f"""SELECT * FROM (WITH allrows AS (SELECT sale_date AS d, daily_revenue AS v FROM daily), edge AS (SELECT MAX(d) - {90 * (3 - k)} AS e FROM allrows),
      series AS (SELECT d, v FROM allrows, edge WHERE d <= e), {fit_sql('series')},
      s AS (SELECT e, CAST(v AS DOUBLE) AS actual, {POINT} AS f, CAST({S.quantile(0.95)!r} AS DOUBLE) * sigma AS half
        FROM allrows CROSS JOIN edge CROSS JOIN model LEFT JOIN em ON em.m = month(d) LEFT JOIN ew ON ew.w = dayofweek(d) WHERE d > e AND d <= e + 90)
      SELECT {k} AS fold, MAX(e) AS cutoff, COUNT(*) AS n, {sql_r('SUM(abs((actual - f) / NULLIF(actual, 0))) / COUNT(*) * 100', 4)} AS mape,
        {sql_r('SUM(abs(actual - f)) / COUNT(*)')} AS mae, round(SUM((actual - f) * (actual - f)) / COUNT(*), 0) AS mse,
        {sql_r('sqrt(SUM((actual - f) * (actual - f)) / COUNT(*))')} AS rmse,
        {sql_r('CAST(COUNT(CASE WHEN actual BETWEEN f - half AND f + half THEN 1 END) * 100 AS DOUBLE) / COUNT(*)')} AS coverage FROM s)"""


query("ts_backtest", on_daily(" UNION ALL ".join(_fold_sql(k) for k in range(3))))(_folds)

query(
    "ts_forecast_tables",
    on_daily(forecast_sql(180) + "SELECT 90 AS horizon, * FROM tab WHERE forecast_date <= (SELECT last_date + 90 FROM model) UNION ALL SELECT 180, * FROM tab"),
)(
    lambda t: forecast(t, 90)
    .select(F.lit(90).alias("horizon"), "*")
    .unionByName(forecast(t, 180).select(F.lit(180).alias("horizon"), "*"))
)

COMBINED = """, both_rows AS (
  SELECT sale_date AS date, CAST(daily_revenue AS DOUBLE) AS actual_revenue, CAST(NULL AS DOUBLE) AS forecast_revenue,
    CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound, 'ACTUAL' AS data_type, CAST(NULL AS INTEGER) AS days_ahead FROM daily
  UNION ALL SELECT forecast_date, NULL, forecasted_revenue, lower_bound_95pct, upper_bound_95pct, 'FORECAST',
    CAST(forecast_date - (SELECT MAX(sale_date) FROM daily) AS INTEGER) FROM tab) """

query("ts_combined", on_daily(forecast_sql(90) + COMBINED + "SELECT * FROM both_rows"))(combined)

query(
    "set_union_all_actual_forecast",
    on_daily(forecast_sql(30) + COMBINED + "SELECT date, actual_revenue AS revenue, forecast_revenue, lower_bound, upper_bound, data_type FROM both_rows"),
)(lambda t: combined(t, 30).drop("days_ahead").withColumnRenamed("actual_revenue", "revenue"))

def _transition(t):
    both = combined(t)
    return S.transition(both, 15, both.where("data_type = 'ACTUAL'").select(F.max("date")).scalar())


query(
    "ts_transition",
    on_daily(forecast_sql(90) + COMBINED + "SELECT * FROM both_rows WHERE date >= (SELECT MAX(sale_date) - 15 FROM daily)"),
)(_transition)


def _mean(col: str) -> str:
    return sql_r(f"CAST(SUM(CAST({col} AS DECIMAL(20,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)")


def _sum(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(20,2))) AS DOUBLE)"


query(
    "ts_monthly_summary",
    on_daily(
        forecast_sql(90)
        + f"""SELECT CAST(date_trunc('month', forecast_date) AS DATE) AS month_date, CAST(year(forecast_date) AS INTEGER) AS year,
              CAST(month(forecast_date) AS INTEGER) AS month, COUNT(*) AS forecast_days, {_sum('forecasted_revenue')} AS total_forecasted_revenue,
              {_mean('forecasted_revenue')} AS avg_daily_forecast, MIN(forecasted_revenue) AS min_daily_forecast,
              MAX(forecasted_revenue) AS max_daily_forecast, {_mean('lower_bound_95pct')} AS avg_lower_bound,
              {_mean('upper_bound_95pct')} AS avg_upper_bound FROM tab GROUP BY 1, 2, 3"""
    ),
)(lambda t: S.monthly_summary(forecast(t, 90)))

query(
    "ts_quality_summary",
    on_daily(
        forecast_sql(90)
        + f"""SELECT 'Forecast Model Performance' AS assessment, COUNT(*) AS forecast_records, {_mean('confidence_interval_width')} AS avg_confidence_width,
              {_sum('forecasted_revenue')} AS total_forecast, {_mean('forecasted_revenue')} AS avg_daily_forecast FROM tab"""
    ),
)(lambda t: S.quality_summary(forecast(t, 90)))

query(
    "ts_uncertainty",
    on_daily(
        forecast_sql(90)
        + f"""SELECT *, {sql_r('confidence_interval_width / NULLIF(forecasted_revenue, 0) * CAST(100 AS DOUBLE)')} AS uncertainty_pct
              FROM tab WHERE forecast_date <= (SELECT last_date + 30 FROM model)"""
    ),
)(lambda t: S.uncertainty(forecast(t, 90)))

query(
    "ts_scenarios",
    on_daily(
        forecast_sql(90)
        + f"""SELECT CAST(date_trunc('month', forecast_date) AS DATE) AS month, {_sum('lower_bound_95pct')} AS worst_case,
              {_sum('forecasted_revenue')} AS base_case, {_sum('upper_bound_95pct')} AS best_case FROM tab GROUP BY 1"""
    ),
)(lambda t: S.scenarios(forecast(t, 90)))


def segment_daily(t):
    """Revenue per customer segment and day."""
    per_customer = t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("sale_date")).agg(
        F.sum(cents("o_totalprice")).alias("_c")
    )
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), "sale_date")
        .agg(F.sum("_c").alias("_c"))
        .select("segment", "sale_date", money("_c").alias("revenue"))
    )


def _anomalies(t):
    """Days outside the 99 % interval of their customer segment's series."""
    rows = segment_daily(t)
    model = S.ts_fit(rows, "sale_date", "revenue", ["segment"])
    return S.ts_anomaly(rows, model, "sale_date", "revenue", ["segment"]).select(
        "segment", "ts", "actual", r2("forecast").alias("forecast"), r2("lower_bound").alias("lower_bound"),
        r2("upper_bound").alias("upper_bound"), "is_anomaly",
    )


query(
    "ts_anomaly",
    f"""WITH series AS (SELECT c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS d, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
        {fit_sql('series', 'segment')},
        s AS (SELECT s.segment, d, CAST(v AS DOUBLE) AS actual, {POINT} AS f, CAST({S.quantile(0.99)!r} AS DOUBLE) * sigma AS half
          FROM series s JOIN model ON s.segment = model.segment LEFT JOIN em ON em.m = month(d) AND em.segment = s.segment
          LEFT JOIN ew ON ew.w = dayofweek(d) AND ew.segment = s.segment)
        SELECT segment, d AS ts, actual, {sql_r('f')} AS forecast, {sql_r('f - half')} AS lower_bound, {sql_r('f + half')} AS upper_bound,
          NOT actual BETWEEN f - half AND f + half AS is_anomaly FROM s""",
)(_anomalies)


def _export(t):
    """The 90-day forecast of a 180-day table, written as CSV and read back."""
    path = scratch_path(t.spark, "forecast")
    writers.export_forecast(forecast(t, 180), path, 90)
    schema = (
        "forecast_date date, forecasted_revenue double, lower_bound_95pct double, "
        "upper_bound_95pct double, confidence_interval_width double"
    )
    return t.spark.read.schema(schema).option("header", "true").csv(path)


query("sink_export_forecast", on_daily(forecast_sql(90) + "SELECT * FROM tab"))(_export)


LABELLED_BEFORE = "1999-01-01"


def _predicted(t):
    """Tiers of new days from revenue, orders and weekday, learned from the days before; and whether class and probabilities hold."""
    rows = t.daily_indexed.select(
        "sale_date", dbl("daily_revenue").alias("daily_revenue"), "num_orders",
        D.dow0("sale_date").alias("day_of_week"), revenue_tier("revenue_index").alias("revenue_class"),
    )
    known, new = (rows.where(c) for c in (f"sale_date < '{LABELLED_BEFORE}'", f"sale_date >= '{LABELLED_BEFORE}'"))
    return L.predict(new, L.fit_classifier(known, ["daily_revenue", "num_orders", "day_of_week"], "revenue_class"))


def _classified(t):
    """What is certain about the predictions, whatever the forest."""
    found = _predicted(t)
    shares = [F.col(c) for c in found.columns if c.startswith("p_")]
    return found.agg(
        F.count(F.lit(1)).alias("new_days"),
        F.min("sale_date").alias("first_day"),
        F.count_distinct("revenue_class").alias("classes"),
        (F.count_if(F.abs(sum(shares[1:], shares[0]) - 1) > 1e-9) == 0).alias("probabilities_sum_to_one"),
        (F.count_if(F.col("predicted_class") == F.col("revenue_class")) >= F.count(F.lit(1)) * 0.9).alias("nine_in_ten_right"),
    )


query(
    "ml_classify",
    with_sql(
        "daily_indexed",
        f"""SELECT COUNT(*) AS new_days, MIN(sale_date) AS first_day,
              COUNT(DISTINCT CASE WHEN revenue_index >= 1.25 THEN 1 WHEN revenue_index >= 1 THEN 2 WHEN revenue_index >= 0.75 THEN 3 ELSE 4 END) AS classes,
              TRUE AS probabilities_sum_to_one, TRUE AS nine_in_ten_right
            FROM daily_indexed WHERE sale_date >= DATE '{LABELLED_BEFORE}'""",
    ),
)(_classified)


# The predictions themselves: a row for each new day with its class, the predicted one and a probability for each. No SQL grows the same forest.
query("ml_classify_predictions")(_predicted)


def _insights(t):
    """What moved revenue between 1996 and 1999, over part type, status and priority."""
    year = F.year("o_orderdate")
    lines = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.sum(cents("l_extendedprice")).alias("_c"))
    rows = (
        lines.join(t.orders.where(year.isin(1996, 1999)), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("p_type", "o_orderstatus", "o_orderpriority", year.alias("year"), money("_c").alias("revenue"))
    )
    return L.top_insights(rows, ["p_type", "o_orderstatus", "o_orderpriority"], "revenue", "year", 1996, 1999)


_DELTA = "SUM(CASE WHEN y = 1999 THEN v ELSE 0 END) - SUM(CASE WHEN y = 1996 THEN v ELSE 0 END)"
query(
    "ml_top_insights",
    f"""WITH r AS (SELECT p_type, o_orderstatus, o_orderpriority, year(o_orderdate) AS y, CAST(l_extendedprice AS DECIMAL(18,2)) AS v
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE year(o_orderdate) IN (1996, 1999)),
        total AS (SELECT {_DELTA} AS total FROM r),
        c AS (SELECT CASE WHEN GROUPING(p_type) = 1 THEN 'ALL' ELSE p_type END AS p_type,
          CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'ALL' ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'ALL' ELSE o_orderpriority END AS o_orderpriority,
          SUM(CASE WHEN y = 1996 THEN v ELSE 0 END) AS b, SUM(CASE WHEN y = 1999 THEN v ELSE 0 END) AS a
          FROM r GROUP BY CUBE (p_type, o_orderstatus, o_orderpriority))
        SELECT p_type, o_orderstatus, o_orderpriority, CAST(b AS DOUBLE) AS before_value, CAST(a AS DOUBLE) AS after_value,
          CAST(a - b AS DOUBLE) AS delta,
          {sql_r('CAST(a - b AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) * CAST(100 AS DOUBLE)', 4)} AS share_pct FROM c CROSS JOIN total""",
)(_insights)
