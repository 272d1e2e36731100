"""The layered pipeline, its log, and plans that must hold at scale."""

from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from brightledger.operators import quality as Q
from brightledger.operators import star
from brightledger.operators import windows as WN
from brightledger.plans import medallion
from brightledger.plans.relations import Tables
from brightledger.session import scratch_path, shared_dir
from brightledger.sources.versions import VersionedTable

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dry_run_writes_nothing(spark, tmp_path):
    out = medallion.run_medallion(spark, SF, str(tmp_path / "m"), dry_run=True)
    assert out.count() == len(medallion.STEPS)
    assert not (tmp_path / "m").exists()


def test_layers_and_reruns(spark, tmp_path):
    out = str(tmp_path / "m")
    medallion.run_medallion(spark, SF, out, layers=["bronze", "silver"])
    log = medallion.run_medallion(spark, SF, out, layers=["silver"], as_of="2024-07-01")
    assert log.where("status = 'SUCCESS'").count() == 6
    customers = VersionedTable(spark, f"{out}/silver/customer").read()
    assert customers.count() == Tables(spark, SF).customer.count()  # unchanged rows open no new version
    assert all(r.passed for r in Q.scd_rules(customers, "customer_id").collect())
    with pytest.raises(ValueError):
        medallion.run_medallion(spark, SF, out, layers=["copper"])


def test_stops_at_the_first_failure(spark, tmp_path, monkeypatch):
    def broken(t, read, as_of):
        raise RuntimeError("planted")

    steps = [s if s[:2] != ("silver", "daily_sales") else ("silver", "daily_sales", broken, ()) for s in medallion.STEPS]
    monkeypatch.setattr(medallion, "STEPS", steps)
    out = str(tmp_path / "m")
    with pytest.raises(RuntimeError):
        medallion.run_medallion(spark, SF, out)
    log = spark.read.parquet(f"{out}/pipeline_log").collect()
    assert [(r.table_name, r.status) for r in log if r.status == "FAILED"] == [("daily_sales", "FAILED")]
    assert len(log) == 3


def test_scratch_follows_the_cluster_setting():
    cluster = MagicMock()
    cluster.conf.get.return_value = "hdfs://shared/checkpoints/"
    cluster.sparkContext.master = "yarn"
    cluster.sparkContext.applicationId = "app-1"
    assert scratch_path(cluster, "x").startswith("hdfs://shared/checkpoints/brightledger-app-1/x-")


def test_no_machine_local_folder_on_a_cluster():
    cluster = MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.getConf.return_value.get.return_value = None
    cluster.sparkContext.getCheckpointDir.return_value = None
    cluster.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError):
        shared_dir(cluster)


def test_scans_read_only_what_they_need(spark):
    t = Tables(spark, SF)
    text = plan(t.daily.select("sale_date").distinct())
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    monthly = plan(t.orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("o_custkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in monthly


def test_topk_prunes_before_the_shuffle(spark):
    t = Tables(spark, SF)
    df = WN.topk(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2)
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2


def test_hot_keys_meet_no_window(spark):
    """Deduplication and new-customer counts aggregate on the map side instead of sorting a hot key."""
    t = Tables(spark, SF)
    assert "Window" not in plan(WN.dedup_latest(t.events, ["user_id"], ["ts", "event_id"]))
    assert "partial_max_by" in plan(WN.dedup_latest(t.events, ["user_id"], ["ts", "event_id"]))
    fact = star.gold_fact_sales(t.lineitem, t.orders, t.part)
    assert "Window" not in plan(star.gold_agg_daily_sales(fact))


def test_hot_customer_in_daily_totals(spark):
    """A customer with most of the rows is counted like any other."""
    rows = [(20240101 + i % 3, 7 if i % 3 else i, i % 5, 1, 10, False) for i in range(300)]
    fact = spark.createDataFrame(rows, "date_id int, customer_id bigint, product_id bigint, quantity int, net int, is_cancelled boolean").withColumn(
        "net_amount", F.col("net").cast("decimal(18,2)")
    )
    out = star.gold_agg_daily_sales(fact)
    last = out.where("date_id = 20240103")
    assert {(r.new_customers, r.repeat_customers) for r in last.collect()} == {(0, 1)}
    assert out.agg(F.sum("transaction_count")).first()[0] == 300
    first_day = star.gold_agg_daily_sales(fact, day=20240101)
    assert first_day.agg(F.sum("new_customers")).first()[0] == 100


def test_only_the_last_day_meets_earlier_customers(spark):
    """Totals of other days, and of rows without a day, are not moved for the join with the customers seen before."""
    rows = [(d, c, 0, 1, False) for d in (20240101, 20240102, None) for c in (1, 2, None)] + [(20240102, 3, 0, 5, False), (20240103, 4, 0, 1, True)]
    rows += [(20240103, c, 0, 1, False) for c in (2, 8, 9)]
    fact = spark.createDataFrame(rows, "date_id int, customer_id bigint, product_id bigint, quantity int, is_cancelled boolean").withColumn("net_amount", F.col("quantity").cast("decimal(18,2)"))
    out = star.gold_agg_daily_sales(fact)
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.date_id, r.customer_id): (r.transaction_count, r.new_customers, r.repeat_customers) for r in out.collect()}
    want = {(d, c): (1, 0, 0) for d, c, _, _, x in rows if not x}
    want |= {(20240103, 2): (1, 0, 1), (20240103, 8): (1, 1, 0), (20240103, 9): (1, 1, 0)}
    assert got == want and out.count() == len(want)
    assert star.gold_agg_daily_sales(fact, day=20240109).agg(F.sum("new_customers"), F.count("*")).first() == (0, len(want))
    undated = fact.withColumn("date_id", F.lit(None).cast("int"))
    assert star.gold_agg_daily_sales(undated).agg(F.sum("new_customers"), F.sum("transaction_count")).first() == (0, len(rows) - 1)
    assert star.gold_agg_daily_sales(fact.limit(0)).count() == 0


def test_ranges_are_found_by_compiled_code(spark):
    """Every number of bounds gives the ranges of a plain search; a lambda over the steps would be run row by row, uncompiled."""
    from bisect import bisect_right

    from brightledger.operators import layout

    source = spark.range(60).withColumn("k", F.when(F.col("id") != 30, F.col("id")))
    for n in (1, 2, 3, 4, 7, 8, 21):
        bounds = [60 * k // n for k in range(n)]
        out = layout.clustered(source, F.col("k"), bounds, "id")
        assert "lambda" not in plan(out)
        parts = out.rdd.glom().collect()
        assert {r.id: at for at, p in enumerate(parts) for r in p} == {i: 0 if i == 30 else bisect_right(bounds, i) for i in range(60)}


def test_scratch_data_lies_in_one_folder_that_can_be_cleared(spark):
    from pathlib import Path

    from brightledger.operators.layout import stored
    from brightledger.session import clear_scratch, run_dir

    kept = stored(spark.range(3), "three")
    assert kept.count() == 3 and any(p.name.startswith("three-") for p in Path(run_dir(spark)).iterdir())
    assert clear_scratch(spark) and not Path(run_dir(spark)).exists() and not clear_scratch(spark)


def test_a_hot_join_key_is_split(spark, rows):
    """AQE splits the partition of a key that holds most of the line rows, and the fact is the same."""
    t = Tables(spark, SF)
    hot = t.lineitem.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 > 0, F.lit(7)).otherwise(F.col("l_orderkey")))
    hot = hot.repartition(16)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    want = rows(star.gold_fact_sales(hot, t.orders, t.part))
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = star.gold_fact_sales(hot, t.orders, t.part)
        got = rows(fact)
        text = plan(fact)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want
    assert "skew=true" in text


def test_clustered_rows_are_made_once(spark):
    """Ranges from known bounds: a counter below the layout sees every row once, and ranges don't overlap."""
    from brightledger.operators import layout

    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    source = spark.range(4000).selectExpr("IF(id % 3 = 0, 77, id * 7919 % 1000) AS a", "id AS b")
    key = F.col("a") * 10000 + F.col("b")
    bounds = layout.range_bounds(source, key, 8)
    out = layout.clustered(source.mapInArrow(seen, source.schema), key, bounds, "a", "b")
    parts = out.rdd.glom().collect()
    assert made.value == 4000 and sum(map(len, parts)) == 4000 and "rangepartitioning" not in plan(out)
    sizes = [len(p) for p in parts if p]
    assert len(sizes) == 8 and max(sizes) < 1.5 * 4000 / 8
    assert [tuple(r) for p in parts for r in p] == sorted(tuple(r) for p in parts for r in p)
    assert layout.range_bounds(source.limit(0), key, 8) == [] and layout.clustered(source, key, [], "a").count() == 4000
    empty = source.withColumn("a", F.when(F.col("b") % 2 == 0, F.col("a")))
    assert layout.clustered(empty, F.col("a") * 10000 + F.col("b"), bounds, "a", "b").count() == 4000


def test_distinct_counts_expand_nothing(spark):
    t = Tables(spark, SF)
    from brightledger.operators import aggregates as A

    for df in (A.customer_metrics(t.customer, t.orders), A.distinct_counts(t.orders), A.distinct_counts(t.orders, True), A.customer_metrics_from(t.customer, A.customer_days(t.orders))):
        assert "Expand" not in plan(df)


def test_sketched_customer_metrics(spark, rows):
    """Merged states of two loads equal the state of both, an order that comes twice is one, and the estimate is close."""
    from brightledger.operators import aggregates as A

    t = Tables(spark, "/root/testdata/sf0.01")
    exact = {r.c_custkey: r for r in A.customer_metrics(t.customer, t.orders).collect()}
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    state = A.merge_customer_days(A.customer_days(t.orders.where(early)), A.customer_days(t.orders.where(~early)))
    got = {r.c_custkey: r for r in A.customer_metrics_from(t.customer, state).collect()}
    assert set(got) == set(exact)
    for k, r in exact.items():
        assert {c: v for c, v in got[k].asDict().items() if c != "total_transactions"} == {c: v for c, v in r.asDict().items() if c != "total_transactions"}
        assert abs(got[k].total_transactions - r.total_transactions) <= max(1, 0.05 * r.total_transactions)
    hot = t.orders.withColumn("o_custkey", F.lit(1).cast("bigint"))
    twice = A.merge_customer_days(A.customer_days(hot), A.customer_days(hot))
    one = next(r for r in A.customer_metrics_from(t.customer, twice).collect() if r.c_custkey == 1)
    n = hot.select("o_orderkey").distinct().count()
    assert abs(one.total_transactions - n) <= 0.05 * n
    many = spark.createDataFrame([(1, 5, 2.0, "2024-01-01"), (1, 5, 3.0, "2024-01-02"), (1, 6, 1.0, "2024-01-02"), (1, None, 1.0, "2024-01-03"), (2, 7, 1.0, None)], "o_custkey long, o_orderkey long, o_totalprice double, d string")
    many = many.withColumn("o_orderdate", F.col("d").cast("timestamp_ntz"))
    c = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "c_custkey long, c_name string")
    assert rows(A.customer_metrics(c, many), "c_custkey", "total_transactions", "days_with_purchase", "total_revenue") == [(1, 2, 3, 7.0), (2, 1, 0, 1.0), (3, 0, 0, None)]


def test_a_quote_may_separate_texts(spark):
    from brightledger.operators import aggregates as A

    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, t string, o int")
    assert A.text_per_group(df, "k", "t", "o", "' \\ '").first().full_text == "x' \\ 'y"
