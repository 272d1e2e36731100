"""Change data, versions, streams and kept summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes as C
from ..session import scratch_path
from ..sources.audit import PipelineLog
from ..sources.kept import KeptTable
from ..sources.parts import BucketTable
from ..streaming import jobs
from .q_relational import AVG, MAX, MONTH, PER_ORDER, QUARTER, SUM, SUM_N, on_daily
from .registry import query
from .relations import with_sql

KEY = ["c_custkey"]
COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
N_COLS = ", ".join(f"n.{c}" for c in COLS.split(", "))
O_COLS = ", ".join(f"o.{c}" for c in COLS.split(", "))
CHANGED = "n.c_mktsegment <> o.c_mktsegment"

APPLIED = """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 11 <> 0"""


def _statements():
    """UPDATE of every 7th key and DELETE of every 11th."""
    return {"set_values": {"c_acctbal": F.col("c_acctbal") * 2}, "where": F.col("c_custkey") % 7 == 0, "delete_where": F.col("c_custkey") % 11 == 0}


query("apply_changes", APPLIED)(lambda t: C.apply_changes(t.customer, **_statements()))


def _applied_in_place(t):
    """The same changes to a stored table, which rewrites the buckets they touch."""
    table = BucketTable(t.spark, scratch_path(t.spark, "customers"), t.customer.schema.toDDL(), KEY, buckets=16)
    table.load(t.customer)
    table.update(**_statements())
    return table.read()


query("apply_changes_stored", APPLIED)(_applied_in_place)

NET = f"""
  SELECT {O_COLS}, 'DELETE' AS action, n.c_custkey IS NOT NULL AS is_update, md5(CAST(o.c_custkey AS VARCHAR)) AS row_id
  FROM customer o LEFT JOIN customer_v2 n ON o.c_custkey = n.c_custkey WHERE n.c_custkey IS NULL OR {CHANGED}
  UNION ALL
  SELECT {N_COLS}, 'INSERT', o.c_custkey IS NOT NULL, md5(CAST(n.c_custkey AS VARCHAR))
  FROM customer_v2 n LEFT JOIN customer o ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NULL OR {CHANGED}"""

query("cdc_net_changes", with_sql("customer_v2", NET))(lambda t: C.net_changes(t.customer, t.customer_v2, KEY))

query(
    "cdc_append_only",
    with_sql("customer_v2", f"SELECT {N_COLS} FROM customer_v2 n WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)"),
)(lambda t: C.appended(t.customer, t.customer_v2, KEY))


def _feed(t):
    """The net changes of the customers as files, and a stream over them."""
    path = scratch_path(t.spark, "changes")
    changes = C.net_changes(t.customer, t.customer_v2, KEY)
    changes.write.parquet(path)
    return jobs.follow(t.spark, path, changes.schema)


def _consumed(t):
    log, checkpoint = scratch_path(t.spark, "change-log"), scratch_path(t.spark, "checkpoint")
    stream = _feed(t)
    jobs.consume(stream, log, checkpoint)
    jobs.consume(stream, log, checkpoint)  # nothing is left to consume
    return t.spark.read.parquet(log).select("c_custkey", "c_mktsegment", "row_id", "change_type")


query(
    "cdc_consume_log",
    with_sql(
        "customer_v2",
        f"""SELECT c_custkey, c_mktsegment, row_id, CASE WHEN action = 'INSERT' AND NOT is_update THEN 'INSERT'
              WHEN action = 'INSERT' THEN 'UPDATE' ELSE 'DELETE' END AS change_type
            FROM ({NET}) WHERE NOT (action = 'DELETE' AND is_update)""",
    ),
)(_consumed)


def _run_if_data(t):
    """Three runs: with data, without, and after more has come. The output tells which ran and what it took."""
    source, out, checkpoint = (scratch_path(t.spark, x) for x in ("source", "out", "checkpoint"))
    t.events.where("event_type <> 'purchase'").write.mode("append").parquet(source)
    stream = jobs.follow(t.spark, source, t.events.schema)

    def take(batch, batch_id):
        batch.agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    ran = [jobs.run_if_data(stream, checkpoint, take), jobs.run_if_data(stream, checkpoint, take)]
    t.events.where("event_type = 'purchase'").write.mode("append").parquet(source)
    ran.append(jobs.run_if_data(stream, checkpoint, take))
    flags = t.spark.createDataFrame([(i + 1, r) for i, r in enumerate(ran)], "run int, ran boolean")
    batches = t.spark.read.parquet(out).select((F.col("batch_id") * 2 + 1).cast("int").alias("run"), "rows")
    return flags.join(batches, "run", "left")


query(
    "cdc_run_if_data",
    """SELECT 1 AS run, TRUE AS ran, COUNT(*) AS rows FROM events WHERE event_type <> 'purchase'
       UNION ALL SELECT 2, FALSE, NULL
       UNION ALL SELECT 3, TRUE, COUNT(*) FROM events WHERE event_type = 'purchase'""",
)(_run_if_data)


def _hourly(t):
    out, checkpoint = scratch_path(t.spark, "hourly"), scratch_path(t.spark, "checkpoint")
    # Written as a pattern, the path may be one file or a folder of files.
    stream = jobs.follow(t.spark, f"{t.dir}/events.parque[t]", t.events.schema)
    jobs.hourly_rollup(stream, "ts", out, checkpoint)
    return jobs.read_rollup(t.spark, out)


HOURLY = "SELECT date_trunc('hour', ts) AS hour, CAST(COUNT(*) AS BIGINT) AS new_rows FROM events GROUP BY 1"

query("stream_hourly_rollup", HOURLY)(_hourly)


def _windowed(t):
    """The same counts from event-time windows with state. All events come in one batch, so none is late."""
    out, checkpoint = scratch_path(t.spark, "windows"), scratch_path(t.spark, "checkpoint")
    jobs.windowed_rollup(jobs.follow(t.spark, f"{t.dir}/events.parque[t]", t.events.schema), "ts", out, checkpoint)
    return jobs.read_windows(t.spark, out)


query("stream_hourly_windows", HOURLY)(_windowed)


def kept_customers(t):
    """The customers with their history: all inserted in January 2024, the later version committed in June, a snapshot after each."""
    kept = KeptTable(t.spark, scratch_path(t.spark, "kept"), t.customer.schema.toDDL(), KEY, every=1)
    kept.append(t.customer.withColumn("op", F.lit("I")), "2024-01-01 00:00:00")
    changed = C.labelled(C.net_changes(t.customer, t.customer_v2, KEY))
    kept.append(changed.withColumn("op", F.substring("change_type", 1, 1)), "2024-06-01 00:00:00")
    return kept


def _as_of(t):
    kept = kept_customers(t)
    views = {
        "at March": kept.as_of("2024-03-01 00:00:00"),
        "at July": kept.as_of("2024-07-01 00:00:00"),
        "90 days before July": kept.as_of("2024-07-01 00:00:00", -90 * 86400),
        "before change 2": kept.before_change(2),
    }
    out = None
    for name, df in views.items():
        part = df.select(F.lit(name).alias("moment"), "c_custkey", "c_mktsegment")
        out = part if out is None else out.unionByName(part)
    return out


query(
    "table_as_of",
    with_sql(
        "customer_v2",
        """SELECT 'at March' AS moment, c_custkey, c_mktsegment FROM customer
           UNION ALL SELECT 'at July', c_custkey, c_mktsegment FROM customer_v2
           UNION ALL SELECT '90 days before July', c_custkey, c_mktsegment FROM customer
           UNION ALL SELECT 'before change 2', c_custkey, c_mktsegment FROM customer""",
    ),
)(_as_of)

query(
    "restore_rows",
    with_sql(
        "customer_v2",
        f"""SELECT {COLS} FROM customer_v2 UNION ALL
            SELECT {COLS} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM customer_v2)""",
    ),
)(lambda t: kept_customers(t).restore("2024-03-01 00:00:00"))

query(
    "table_compare",
    with_sql(
        "customer_v2",
        f"SELECT 'ORIGINAL' AS source, {COLS} FROM customer UNION ALL SELECT 'CLONE', {COLS} FROM customer_v2",
    ),
)(lambda t: C.side_by_side(t.customer, t.customer_v2))

SPLIT = "1998-06-15"


def _summaries(t):
    """Summaries fed in two loads that meet within a month, quarter and year."""
    source = scratch_path(t.spark, "orders")
    kept = jobs.RevenueSummaries(t.spark, scratch_path(t.spark, "summaries"))
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    for part in (early, ~early):
        t.orders.where(part).write.mode("append").parquet(source)
        kept.refresh(jobs.follow(t.spark, source, t.orders.schema), "o_orderdate", "o_totalprice")
    return kept


query(
    "incr_monthly",
    on_daily(
        f"""SELECT {MONTH} AS month, {SUM} AS total_revenue, {SUM_N} AS total_orders, {AVG} AS avg_daily, {MAX} AS best_day
            FROM daily GROUP BY 1"""
    ),
)(lambda t: _summaries(t).monthly())

query(
    "incr_quarterly",
    on_daily(
        f"""SELECT {QUARTER} AS quarter, {SUM} AS quarterly_revenue, {SUM_N} AS quarterly_orders, {PER_ORDER} AS revenue_per_order
            FROM daily GROUP BY 1"""
    ),
)(lambda t: _summaries(t).quarterly())

query(
    "incr_yearly",
    on_daily(
        f"SELECT CAST(year(sale_date) AS INTEGER) AS year, {SUM} AS annual_revenue, {SUM_N} AS annual_orders FROM daily GROUP BY 1"
    ),
)(lambda t: _summaries(t).yearly())


def _history(t):
    """One log entry per loaded table, and one for a load that fails."""
    log = PipelineLog(t.spark, scratch_path(t.spark, "log"))
    for name in ("orders", "customer", "events"):
        log.run("bronze", name, lambda n=name: t.table(n).count())

    def broken():
        raise ValueError("planted")

    try:
        log.run("silver", "customer", broken)
    except ValueError:
        pass
    return log.newest(10).select("layer", "table_name", "row_count", "status", "error_message")


query(
    "refresh_history",
    """SELECT 'bronze' AS layer, 'orders' AS table_name, COUNT(*) AS row_count, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message FROM orders
       UNION ALL SELECT 'bronze', 'customer', COUNT(*), 'SUCCESS', NULL FROM customer
       UNION ALL SELECT 'bronze', 'events', COUNT(*), 'SUCCESS', NULL FROM events
       UNION ALL SELECT 'silver', 'customer', NULL, 'FAILED', 'ValueError: planted'""",
)(_history)
