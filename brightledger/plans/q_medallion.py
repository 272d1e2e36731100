"""The whole pipeline as one query: rows per written table."""

from __future__ import annotations

from ..session import scratch_path
from .medallion import run_medallion
from .q_quality import FACT
from .registry import query
from .relations import with_sql

_CUBE = "(SELECT 1 FROM fact WHERE NOT is_cancelled GROUP BY date_id, customer_id, product_id)"
_COUNTS = [
    ("bronze", "daily_sales", "SELECT COUNT(*) FROM daily"),
    ("bronze", "customer", "SELECT COUNT(*) FROM customer"),
    ("silver", "daily_sales", "SELECT COUNT(*) FROM daily"),
    ("silver", "customer", "SELECT COUNT(*) FROM customer"),
    ("gold", "dim_date", "SELECT make_date(year(MAX(sale_date)), 12, 31) - make_date(year(MIN(sale_date)), 1, 1) + 1 FROM daily"),
    ("gold", "dim_product", "SELECT COUNT(*) FROM part"),
    ("gold", "fact_daily_sales", "SELECT COUNT(*) FROM daily"),
    ("gold", "fact_sales", "SELECT COUNT(*) FROM lineitem"),
    ("gold", "agg_daily_sales", f"SELECT COUNT(*) FROM {_CUBE}"),
    ("gold", "agg_monthly_sales", "SELECT COUNT(DISTINCT date_trunc('month', sale_date)) FROM daily"),
    ("gold", "agg_quarterly_sales", "SELECT COUNT(DISTINCT date_trunc('quarter', sale_date)) FROM daily"),
    ("gold", "customer_metrics", "SELECT COUNT(*) FROM customer"),
    ("gold", "forecast_90days", "SELECT 90"),
    ("gold", "forecast_180days", "SELECT 180"),
]

query(
    "medallion_run",
    with_sql(
        "daily",
        f"WITH {FACT} "
        + " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, CAST(({sql}) AS BIGINT) AS row_count, 'SUCCESS' AS status"
            for layer, table, sql in _COUNTS
        ),
    ),
)(
    lambda t: run_medallion(t.spark, t.dir, scratch_path(t.spark, "medallion")).select(
        "layer", "table_name", "row_count", "status"
    )
)
