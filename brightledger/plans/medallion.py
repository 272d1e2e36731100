"""The layered pipeline: bronze, silver, gold.

Each table is one job that reads earlier tables and writes the next version of its own. Layers run
in order and the run stops at the first failure; every job leaves an entry in the pipeline log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..operators import aggregates as A
from ..operators import calendar as C
from ..operators import scd, series, star
from ..operators.layout import clustered, range_bounds
from ..sources.audit import PipelineLog
from ..sources.loading import bronze_load
from ..sources.versions import VersionedTable
from .relations import Tables

LAYERS = ("bronze", "silver", "gold")
CUSTOMER_ATTRS = ["customer_name", "email", "is_valid_email", "is_active"]

Read = Callable[[str], DataFrame]


def _bronze_daily(t: Tables, read: Read, as_of: str) -> DataFrame:
    return t.daily.select(
        "sale_date", "daily_revenue", "num_orders",
        F.lit(as_of).cast("date").alias("_load_date"),
        F.lit("ORDERS").alias("_source_system"),
        F.year("sale_date").alias("_data_year"),
    )


def _bronze_customer(t: Tables, read: Read, as_of: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    staged = t.customer.select(
        key.alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("user"), key, F.lit("@shop"), F.col("c_nationkey").cast("string"), F.lit(".com")).alias("email"),
    )
    return bronze_load(staged, "id", as_of, "CRM")


def _silver_customer(t: Tables, read: Read, as_of: str) -> DataFrame:
    fresh = scd.silver_customer(read("bronze.customer").drop("_source_system"), as_of)
    try:
        current = read("silver.customer")
    except FileNotFoundError:
        return fresh
    return scd.scd2_merge(current, fresh, ["customer_id"], CUSTOMER_ATTRS, as_of).select(*fresh.columns)


def _dim_date(t: Tables, read: Read, as_of: str) -> DataFrame:
    span = read("silver.daily_sales").agg(F.min("sale_date").alias("lo"), F.max("sale_date").alias("hi"))
    first, last = F.trunc("lo", "YEAR"), F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    return C.describe_days(C.date_spine(t.spark, first, F.datediff(last, first) + 1, span, "date"), "date")


def _forecast(days: int):
    def build(t: Tables, read: Read, as_of: str) -> DataFrame:
        model = series.ts_fit(read("silver.daily_sales"), "sale_date", "daily_revenue")
        return series.forecast_table(model, days)

    return build


def _place(date_id: Column, customer: Column) -> Column:
    """Day, then customer, as one number, so that one day with most of the rows still spreads over tasks."""
    return date_id.cast("bigint") * (1 << 32) + F.least(F.greatest(customer, F.lit(0)), F.lit((1 << 32) - 1))


def _by_orders(t: Tables, read: Read) -> tuple[DataFrame, Column]:
    return t.orders, _place(date_key("o_orderdate"), F.col("o_custkey"))


def _by_fact(t: Tables, read: Read) -> tuple[DataFrame, Column]:
    return read("gold.fact_sales"), _fact_place()


def _fact_place() -> Column:
    return _place(F.col("date_id"), F.col("customer_id"))


# (layer, table, builder, where the ranges are taken from that cluster the written files by day and customer)
STEPS: list[tuple[str, str, Callable[[Tables, Read, str], DataFrame], Callable[[Tables, Read], tuple[DataFrame, Column]] | tuple]] = [
    ("bronze", "daily_sales", _bronze_daily, ()),
    ("bronze", "customer", _bronze_customer, ()),
    ("silver", "daily_sales", lambda t, read, d: star.silver_daily_sales(read("bronze.daily_sales")), ()),
    ("silver", "customer", _silver_customer, ()),
    ("gold", "dim_date", _dim_date, ()),
    ("gold", "dim_product", lambda t, read, d: star.gold_dim_product(t.part), ()),
    ("gold", "fact_daily_sales", lambda t, read, d: star.gold_fact_daily(read("silver.daily_sales")), ()),
    ("gold", "fact_sales", lambda t, read, d: star.gold_fact_sales(t.lineitem, t.orders, t.part), _by_orders),
    ("gold", "agg_daily_sales", lambda t, read, d: star.gold_agg_daily_sales(read("gold.fact_sales")), _by_fact),
    ("gold", "agg_monthly_sales", lambda t, read, d: A.gold_agg_monthly(read("gold.fact_daily_sales")), ()),
    ("gold", "agg_quarterly_sales", lambda t, read, d: A.gold_agg_quarterly(read("gold.fact_daily_sales")), ()),
    ("gold", "customer_metrics", lambda t, read, d: A.customer_metrics(t.customer, t.orders), ()),
    ("gold", "forecast_90days", _forecast(90), ()),
    ("gold", "forecast_180days", _forecast(180), ()),
]


def run_medallion(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    layers: Sequence[str] = LAYERS,
    dry_run: bool = False,
    as_of: str = "2024-06-01",
) -> DataFrame:
    """Run the layers in order and return the log entries of all runs so far.

    A layer left out keeps its present tables. A dry run resolves every plan, writes nothing and
    returns (layer, table_name, columns).
    """
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers {sorted(unknown)}")
    tables = Tables(spark, source_dir)
    planned: dict[str, DataFrame] = {}

    def stored(name: str) -> VersionedTable:
        return VersionedTable(spark, f"{out_dir.rstrip('/')}/{name.replace('.', '/')}")

    def read(name: str) -> DataFrame:
        return planned[name] if name in planned else stored(name).read()

    steps = [s for s in STEPS if s[0] in layers]
    if dry_run:
        for layer, table, build, _ in steps:
            planned[f"{layer}.{table}"] = build(tables, read, as_of)
        rows = [(*name.split(".", 1), ",".join(df.columns)) for name, df in planned.items()]
        return spark.createDataFrame(rows, "layer string, table_name string, columns string")

    log = PipelineLog(spark, f"{out_dir.rstrip('/')}/pipeline_log")
    for layer, table, build, cluster in steps:

        def job(layer=layer, table=table, build=build, cluster=cluster) -> int:
            df = build(tables, read, as_of)
            if cluster:
                source, key = cluster(tables, read)
                parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
                df = clustered(df, _fact_place(), range_bounds(source, key, parts), "date_id", "customer_id")
            target = stored(f"{layer}.{table}")
            return target.read(target.write(df, "REFRESH")).count()

        log.run(layer, table, job)
    return log.read()
