"""Readers, writers, load policies and generators, as round trips of the given tables.

Each builder writes a table to the shared scratch folder in the format under test and reads it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.calendar import date_spine
from ..operators.keys import dense_numbers
from ..session import scratch_path
from ..sources import generators, loading, readers, writers
from ..sources.versions import VersionedTable
from .q_relational import REV, on_daily
from .registry import query
from .relations import sql_r

ORDERS_DDL = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)

query(
    "src_parquet",
    "SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_comment FROM orders",
)(
    lambda t: readers.read_parquet(
        t.spark, f"{t.dir}/orders.parquet", "O_ORDERKEY bigint, O_CUSTKEY bigint, O_TotalPrice double, O_Comment string"
    ).toDF("o_orderkey", "o_custkey", "o_totalprice", "o_comment")
)


def _orders_csv(t, **changed):
    """Orders as CSV text, with some columns replaced by planted text."""
    path = scratch_path(t.spark, "orders-csv")
    writers.unload_csv(t.orders.withColumns(changed), path)
    return path


def _csv_typed(t):
    priority = F.when(F.col("o_custkey") % 10 == 0, F.lit("NULL")).when(
        F.col("o_custkey") % 10 == 1, F.lit("")
    ).otherwise(F.concat(F.lit("  "), "o_orderpriority", F.lit(' ')))
    return readers.read_csv_typed(t.spark, _orders_csv(t, o_orderpriority=priority), ORDERS_DDL)


query(
    "src_csv_typed",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_custkey % 10 > 1 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)(_csv_typed)


def _json_variant(t):
    """Events as lines that each hold an array around one record."""
    path = scratch_path(t.spark, "events-json")
    line = F.concat(F.lit("["), F.to_json(F.struct("event_id", "user_id", "event_type", "value")), F.lit("]"))
    t.events.select(line.alias("value")).write.text(path)
    return readers.read_json_variant(t.spark, path).select(
        F.variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.variant_get("record", "$.user_id", "bigint").alias("user_id"),
        F.variant_get("record", "$.event_type", "string").alias("event_type"),
        F.variant_get("record", "$.value", "double").alias("value"),
    )


query("src_json_variant", "SELECT event_id, user_id, event_type, value FROM events")(_json_variant)


def _dirty_orders(t):
    """Orders as CSV where every 97th price is not a number."""
    price = F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    return _orders_csv(t, o_totalprice=price)


query("load_on_error", "SELECT * FROM orders WHERE o_orderkey % 97 <> 0")(
    lambda t: loading.load(t.spark, _dirty_orders(t), "csv", ORDERS_DDL, on_error="CONTINUE")[0]
)

query(
    "load_validate",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'o_totalprice' AS errors, 'n/a' AS raw_value FROM orders WHERE o_orderkey % 97 = 0",
)(
    lambda t: loading.validate_load(t.spark, _dirty_orders(t), "csv", ORDERS_DDL).select(
        F.col("_raw.o_orderkey").alias("o_orderkey"),
        F.concat_ws(",", "_errors").alias("errors"),
        F.col("_raw.o_totalprice").alias("raw_value"),
    )
)

ORDER_TYPES = {
    "o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "STRING",
    "o_totalprice": "DOUBLE", "o_orderdate": "TIMESTAMP_NTZ", "o_orderpriority": "STRING",
}
query(
    "src_infer_schema",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS type, "
        f"COUNT({c}) < COUNT(*) AS nullable, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls FROM orders"
        for i, (c, t) in enumerate(ORDER_TYPES.items())
    ),
)(lambda t: readers.infer_schema(t.spark, _orders_csv(t), "csv"))


def _in_place(t):
    path = scratch_path(t.spark, "part-csv")
    writers.unload_csv(t.part, path, header=False)
    return readers.query_files(t.spark, "csv", path, "_c0 AS c1, _c1 AS c2, _c2 AS c3")


query("src_query_in_place", "SELECT CAST(p_partkey AS VARCHAR) AS c1, p_name AS c2, p_brand AS c3 FROM part")(_in_place)


def _unload(t):
    path = scratch_path(t.spark, "unload")
    writers.unload_csv(t.orders, path, max_file_bytes=500_000)
    return readers.read_csv_typed(t.spark, path, ORDERS_DDL)


query("sink_unload_csv", "SELECT * FROM orders")(_unload)


def _bronze(t):
    staged = t.customer.select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("id"),
        F.col("c_name").alias("name"),
        "c_mktsegment",
        F.col("_metadata.file_name").alias("_file_name"),
    )
    path = scratch_path(t.spark, "bronze")
    loading.append_bronze(loading.bronze_load(staged, "id", "2024-06-01", "CRM"), path)
    return t.spark.read.parquet(path)


query(
    "bronze_load",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment, 'customer.parquet' AS _file_name,
         DATE '2024-06-01' AS _load_date, 'CRM' AS _source_system FROM customer WHERE c_custkey % 50 <> 0""",
)(_bronze)


def _archive(t):
    path = scratch_path(t.spark, "archive")
    loading.archive(t.events, path, "ts", "2024-02-10", 30)
    return t.spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type")


query(
    "bronze_archive",
    "SELECT event_id, ts, user_id, event_type FROM events WHERE ts < DATE '2024-02-10' - 30",
)(_archive)


def _truncate(t):
    """Load, clear, reload: the row count of every version."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "staging"))
    table.write(t.events, "LOAD")
    table.truncate()
    table.refresh(t.events.where("event_type = 'purchase'"))
    counts = [table.read(v).agg(F.count(F.lit(1)).alias("rows")).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).join(
        table.history().select("version", "action"), "version"
    )


query(
    "staging_truncate",
    """SELECT 1 AS version, 'LOAD' AS action, COUNT(*) AS rows FROM events UNION ALL SELECT 2, 'TRUNCATE', 0
       UNION ALL SELECT 3, 'REFRESH', COUNT(*) FROM events WHERE event_type = 'purchase'""",
)(_truncate)


def _ctas(t):
    """Table from a query, a view over it, a projection of the view."""
    path = scratch_path(t.spark, "daily")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    t.daily.write.option("path", path).saveAsTable(f"t_{name}")
    t.spark.table(f"t_{name}").createOrReplaceTempView(f"v_{name}")
    return t.spark.sql(f"SELECT sale_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue FROM v_{name}")


query("ctas_and_views", on_daily(f"SELECT sale_date, {REV} FROM daily"))(_ctas)

query(
    "surrogate_key",
    "SELECT c_custkey, c_name, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key FROM customer",
)(lambda t: dense_numbers(t.customer.select("c_custkey", "c_name"), ["c_custkey"], "customer_key"))

query(
    "gen_date_spine",
    """WITH span AS (SELECT c_mktsegment AS segment, CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
       SELECT segment, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS sale_date FROM span""",
)(
    # One spine per customer segment, from its first to its last order.
    lambda t: date_spine(
        t.spark, F.col("lo"), F.datediff("hi", "lo") + 1,
        t.orders.groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(F.min("lo").cast("date").alias("lo"), F.max("hi").cast("date").alias("hi")),
    ).select("segment", "sale_date")
)

_U = "CAST(('0x' || substr(md5(s_suppkey || '|' || sale_date || '{tag}'), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"
_MONTHS = ", ".join(f"CAST({x} AS DOUBLE)" for x in generators.MONTH_EFFECT)
query(
    "gen_daily_sales",
    f"""WITH days AS (SELECT s_suppkey, CAST(UNNEST(generate_series(DATE '2023-01-01', DATE '2024-12-30', INTERVAL 1 DAY)) AS DATE) AS sale_date
          FROM supplier),
        v AS (SELECT s_suppkey, sale_date,
          CAST(100 AS DOUBLE) + (sale_date - DATE '2023-01-01') * CAST(0.15 AS DOUBLE) + [{_MONTHS}][month(sale_date)]
            + CASE WHEN dayofweek(sale_date) IN (0, 6) THEN CAST(-20 AS DOUBLE) ELSE CAST(10 AS DOUBLE) END
            + (CAST(-15 AS DOUBLE) + {_U.format(tag='|n')} * CAST(30 AS DOUBLE)) AS value,
          CAST(15 AS DOUBLE) + {_U.format(tag='|o')} * CAST(20 AS DOUBLE) AS per_order FROM days)
        SELECT s_suppkey, sale_date, {sql_r('greatest(value, CAST(10 AS DOUBLE))')} AS daily_revenue,
          CAST(floor(greatest(value / per_order, CAST(1 AS DOUBLE)) + CAST(0.5 AS DOUBLE)) AS INTEGER) AS num_orders FROM v""",
)(
    # One synthetic series per supplier.
    lambda t: generators.daily_sales(t.spark, keys=t.supplier.select("s_suppkey"))
)
