"""Joins, windows, hierarchies, dates and user functions on small tables with known answers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brightledger.functions import dates as D
from brightledger.functions import strings as S
from brightledger.functions import udfs as U
from brightledger.functions import variants as V
from brightledger.functions.numbers import min_max_scale, money, round_half_up, zscore
from brightledger.operators import aggregates as A
from brightledger.operators import basics as B
from brightledger.operators import calendar as C
from brightledger.operators import joins as J
from brightledger.operators import learning as L
from brightledger.operators import windows as WN
from brightledger.operators.hierarchy import hierarchy

DAILY = "sale_date date, daily_revenue decimal(20,2), num_orders bigint"


def daily(spark, values, start="2024-01-01"):
    first = dt.date.fromisoformat(start)
    data = [(first + dt.timedelta(days=i), None if v is None else Decimal(str(v)), 2) for i, v in enumerate(values) if v != "gap"]
    return spark.createDataFrame(data, DAILY)


# --- joins ----------------------------------------------------------------------------------


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(12, Decimal("8.40"), 3), (15, Decimal("0.60"), 1), (40, Decimal("31.25"), 9), (41, Decimal("2.00"), 2)],
        "part_id bigint, amount decimal(20,2), num_lines bigint",
    )


@pytest.fixture
def parts(spark):
    return spark.createDataFrame([(12, "hinge"), (13, "axle"), (14, "cog"), (40, "rivet")], "p_partkey bigint, p_name string")


def test_outer_joins(sales, parts, rows):
    assert rows(J.left_with_orphans(sales, parts), "part_id", "part_name") == [(12, "hinge"), (15, None), (40, "rivet"), (41, None)]
    assert rows(J.orphans(sales, parts), "part_id") == [(15,), (41,)]
    assert rows(J.right_all_dim(sales, parts), "part_name", "amount") == [("axle", None), ("cog", None), ("hinge", 8.4), ("rivet", 31.25)]
    assert rows(J.full_both(sales, parts), "part_key") == [(12,), (13,), (14,), (15,), (40,), (41,)]


def test_grid_is_every_pair_of_keys(spark, rows):
    days, kinds = spark.createDataFrame([(1,), (2,), (2,)], "d int"), spark.createDataFrame([("x",), (None,), ("x",)], "k string")
    assert rows(J.grid(days, kinds)) == [(1, None), (1, "x"), (2, None), (2, "x")]
    assert J.grid(days, kinds.where("k = 'z'")).count() == 0


def test_previous_day_is_not_previous_row(spark, rows):
    df = daily(spark, [10, 20, "gap", 40, 50])
    assert [(str(r.today), r.day_over_day) for r in J.day_over_day(df).orderBy("today").collect()] == [
        ("2024-01-02", 10.0), ("2024-01-05", 10.0),
    ]
    prev = {str(r.sale_date): r.change_from_yesterday for r in WN.neighbours(df).collect()}
    assert prev["2024-01-04"] == 20.0


def test_new_and_repeat(spark):
    visits = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "c")], "day int, customer string")
    got = {r.day: (r.new_customers, r.repeat_customers) for r in J.new_and_repeat(visits, "day", "customer").collect()}
    assert got == {1: (2, 0), 2: (1, 1), 3: (0, 1)}


# --- windows --------------------------------------------------------------------------------


def test_latest_per_key(spark, rows):
    readings = spark.createDataFrame(
        [(7, 3, 20.5, "s1"), (7, 3, None, "s9"), (7, 1, 18.0, "s4"), (8, 0, 1.5, "s2"), (None, 5, 2.5, "s3"), (None, 4, 9.0, "s8")],
        "sensor int, tick int, degrees double, row string",
    )
    latest = WN.dedup_latest(readings, ["sensor"], ["tick", "row"])
    assert rows(latest, "row") == [("s2",), ("s3",), ("s9",)]  # the tie on the tick goes to the later row; NULL is a sensor


def test_order_and_nulls(spark):
    df = daily(spark, [3, None, 9, 9, 1])
    days = lambda out: [str(r.sale_date)[-1] for r in out.collect()]
    assert days(B.sorted_nulls_last(df, "daily_revenue", "sale_date")) == ["3", "4", "1", "5", "2"]
    assert days(B.sorted_nulls_last(df, "daily_revenue", "sale_date", 2)) == ["3", "4"]
    assert days(B.sorted_by_position(df, 3)) == ["3", "4", "1"]
    assert days(B.top_days(df, 2, "2024-01-01", 2)) == ["3", "4"]
    assert days(B.sorted_by_month(df, "2024-01-02", 2)) == ["3", "4"]


def test_random_draws_differ(spark):
    draws = spark.range(100).select(F.uniform(F.lit(15.0), F.lit(35.0), F.lit(42)).alias("u"))
    assert draws.distinct().count() > 90


def test_ties(spark):
    df = daily(spark, [5, 7, 7, 1])
    got = {str(r.sale_date)[-1]: (r.rank_val, r.dense_rank_val) for r in WN.ranks(df).collect()}
    assert got == {"2": (1, 1), "3": (1, 1), "1": (3, 2), "4": (4, 3)}
    top = WN.topk(df, [], [F.desc("daily_revenue"), F.asc("sale_date")], 1).first()
    assert str(top.sale_date) == "2024-01-02"


def test_range_frame_counts_days(spark):
    df = daily(spark, [1] * 3 + ["gap"] * 10 + [1])
    last = {str(r.sale_date): r.s for r in WN.rolling_days(df, "daily_revenue", "sale_date", 7, "s").collect()}
    assert last["2024-01-14"] == 1.0 and last["2024-01-03"] == 3.0
    rolled = WN.rolling(df, "daily_revenue", "sale_date", 7, "sum", "s").collect()
    assert {str(r.sale_date): r.s for r in rolled}["2024-01-14"] == 4.0


def test_zscore_of_equal_values_is_null(spark):
    assert {r.revenue_zscore for r in WN.zscore_window(daily(spark, [4, 4, 4]), "daily_revenue", "sale_date").collect()} == {None}
    assert WN.zscore_window(daily(spark, [4]), "daily_revenue", "sale_date").first().revenue_zscore is None


def test_leap_day_looks_at_28_february(spark):
    df = spark.createDataFrame([(dt.date(2023, 2, 28), Decimal(10), 1), (dt.date(2024, 2, 29), Decimal(15), 1)], DAILY)
    got = {str(r.sale_date): (r.revenue_yoy_prior, r.revenue_yoy_pct_change) for r in WN.prior_year(df, "sale_date", "daily_revenue").collect()}
    assert got == {"2023-02-28": (None, None), "2024-02-29": (10.0, 50.0)}
    by_row = WN.prior_year(df, "sale_date", "daily_revenue", previous_rows=1)
    assert {r.revenue_yoy_prior for r in by_row.collect()} == {None, 10.0}


def test_keys_keep_series_apart(spark):
    base = daily(spark, [1, 2, 3]).withColumn("k", F.explode(F.array(F.lit("a"), F.lit("b"))))
    got = WN.rolling_sums(base, ["k"]).where("sale_date = '2024-01-03'").collect()
    assert [r.revenue_7day_rolling for r in got] == [6.0, 6.0]


def test_layers_keep_series_apart(spark):
    from brightledger.operators import star

    one = daily(spark, [i % 11 + 1 for i in range(400)])
    both = one.withColumn("shop", F.lit("a")).unionByName(one.withColumn("daily_revenue", F.col("daily_revenue") * 3).withColumn("shop", F.lit("b")))
    alone = star.gold_fact_daily(star.silver_daily_sales(one)).orderBy("sale_date").collect()
    fact = star.gold_fact_daily(star.silver_daily_sales(both, keys=["shop"]), keys=["shop"])
    for shop, factor in (("a", 1), ("b", 3)):
        rows = fact.where(F.col("shop") == shop).orderBy("sale_date").collect()
        assert [r.revenue_30day_rolling for r in rows] == [factor * r.revenue_30day_rolling for r in alone]
        assert [r.revenue_yoy_pct_change for r in rows] == [r.revenue_yoy_pct_change for r in alone]
    assert alone[-1].revenue_yoy_prior is not None


def test_year_over_year_reads_its_rows_once(spark):
    plan = WN.prior_year(daily(spark, [1, 2, 3]), "sale_date", "daily_revenue")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_gaps_are_filled(spark):
    df = daily(spark, [1, "gap", 3])
    got = WN.fill_gaps(df, F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date")).orderBy("calendar_date").collect()
    assert [(r.revenue, r.status) for r in got] == [(1.0, "HAS SALES"), (0.0, "NO SALES"), (3.0, "HAS SALES")]


@pytest.mark.parametrize("op", [
    B.distinct_months, A.summary, A.monthly, A.quarter_stats, A.gold_agg_monthly, A.exploration, A.seasonality, A.best_and_worst_month,
    WN.ranks, WN.quartiles, WN.relative_positions, WN.neighbours, WN.rolling_sums, WN.month_to_date, J.day_over_day, WN.day_week_overall,
])
def test_empty_and_single_row(spark, op):
    empty = spark.createDataFrame([], DAILY)
    assert op(empty).count() in (0, 1, 2, 6)
    assert op(daily(spark, [3])).count() <= 6


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_same_result_on_any_layout(spark, rows, partitions):
    base = daily(spark, [(i * 37) % 101 + 0.25 for i in range(200)])
    moved = base.repartition(partitions)
    for op in (A.monthly, A.quarter_stats, A.gold_agg_quarterly, WN.ranks, WN.rolling_sums, WN.month_to_date, J.day_over_day, A.best_and_worst_month):
        assert rows(op(moved)) == rows(op(base)), op.__name__


# --- hierarchy ------------------------------------------------------------------------------


def test_hierarchy(spark):
    # Two folder trees; a folder's key is its place on the disk.
    folders = spark.createDataFrame(
        [("u", "usr", None), ("l", "lib", "u"), ("p", "python", "l"), ("e", "etc", None), ("s", "ssl", "e"), ("c", "certs", "s"), ("x", "old", "gone")],
        "key string, name string, inside string",
    )
    got = {r.key: (r.depth, r.path, r.org_chart) for r in hierarchy(folders, "key", "inside", "name", sep="/").collect()}
    assert got["p"] == (2, "usr/lib/python", "    python") and got["c"] == (2, "etc/ssl/certs", "    certs")
    assert got["e"] == (0, "etc", "etc") and set(got) == set("ulpesc")  # a folder in an unknown one hangs below no root


def test_hierarchy_of_any_depth(spark):
    chain = spark.sql("SELECT id, CAST(id AS STRING) AS name, IF(id > 0, id - 1, NULL) AS up FROM range(300)")
    deepest = hierarchy(chain, "id", "up", "name", sep=".").where("id = 299").first()
    assert deepest.depth == 299 and deepest.path == ".".join(map(str, range(300)))


def test_hierarchy_names_the_id_of_a_cycle(spark):
    ring = spark.createDataFrame([(1, "a", None), (5, "b", 7), (6, "c", 5), (7, "d", 6)], "id int, name string, up int")
    with pytest.raises(ValueError, match="[567]"):
        hierarchy(ring, "id", "up", "name")


# --- dates, numbers, strings ----------------------------------------------------------------


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_date_differences_count_boundaries(spark):
    d = lambda s: F.lit(s).cast("date")
    r = one(
        spark,
        months=D.diff_months(d("2024-01-31"), d("2024-02-01")),
        back=D.diff_months(d("2024-02-01"), d("2023-12-31")),
        years=D.diff_years(d("2024-12-31"), d("2025-01-01")),
        weeks=D.diff_weeks(d("2024-06-02"), d("2024-06-03")),  # Sunday to Monday
        same=D.diff_weeks(d("2024-06-03"), d("2024-06-09")),
        days=D.diff_days(d("2024-01-01"), d("2024-12-31")),
    )
    assert tuple(r) == (1, -2, 1, 1, 0, 365)


def test_weekday_numbers(spark):
    sunday = F.lit("2024-06-02").cast("date")
    r = one(spark, a=D.dow0(sunday), b=D.iso_dow(sunday), c=D.is_weekend(sunday), d=D.week_end(sunday), e=D.year_end(sunday))
    assert tuple(r) == (0, 7, True, dt.date(2024, 6, 2), dt.date(2024, 12, 31))


def test_timestamp_differences_ignore_the_session_zone(spark):
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            # Across the New York clock change of 10 March 2024.
            late = one(spark, **{u: D.trunc_wall(t("2024-03-10 02:59:58.7"), u) for u in ("second", "minute", "hour", "day")})
            assert [str(v) for v in late] == ["2024-03-10 02:59:58", "2024-03-10 02:59:00", "2024-03-10 02:00:00", "2024-03-10 00:00:00"]
            r = one(spark, h=D.diff_hours(t("2024-03-10 01:59:00"), t("2024-03-10 03:00:00")), m=D.diff_minutes(t("2024-06-01 08:00:00"), t("2024-06-01 17:30:30")))
            assert tuple(r) == (2, 570)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keys_and_ages(spark):
    day = F.lit("2024-05-09").cast("date")
    r = one(spark, k=D.date_key(day), q=D.quarter_key(day), b=D.date_from_key(D.date_key(day)))
    assert (r.k, r.q, str(r.b)) == (20240509, 20242, "2024-05-09")
    ages = spark.createDataFrame([(30,), (31,), (90,), (365,), (366,)], "n int").select(
        D.age_bucket(F.date_sub(day, F.col("n")), day).alias("b")
    )
    assert [r.b for r in ages.collect()] == ["RECENT", "THIS QUARTER", "THIS QUARTER", "THIS YEAR", "OLDER"]


def test_dim_date_and_spine(spark):
    assert C.date_spine(spark, "2020-01-01", 3).count() == 3 and C.date_spine(spark, "2020-01-01", 0).count() == 0
    dim = C.dim_date(spark, "2020-01-01", "2030-12-31", spark.createDataFrame([(dt.date(2024, 12, 25),)], "d date"))
    assert dim.count() == 4018 and dim.where("is_holiday").count() == 1
    last = dim.orderBy(F.desc("date_id")).first()
    assert (last.date_id, last.is_weekday, last.day_name) == (20301231, True, "Tue")


def test_rounding(spark):
    r = one(spark, a=round_half_up(F.lit(1.125)), b=round_half_up(F.lit(-0.001)), c=round_half_up(F.lit(None).cast("double")), d=money(F.lit(1234567)))
    assert (r.a, str(r.b), r.c, r.d) == (1.13, "0.0", None, Decimal("12345.67"))


def test_scale_guards(spark):
    x = lambda v: F.lit(v).cast("double")
    r = one(spark, a=min_max_scale(x(5.0), x(0.0), x(10.0)), b=min_max_scale(x(5.0), x(5.0), x(5.0)), c=min_max_scale(x(None), x(0.0), x(1.0)), d=zscore(x(3.0), x(1.0), x(0.0)))
    assert tuple(r) == (0.5, 0.0, None, None)


def test_email_domain(spark):
    r = one(spark, **{f"c{i}": S.email_domain(F.lit(v)) for i, v in enumerate(["u@Shop.COM", "none", None, "a@b@c", "@"])})
    assert tuple(r) == ("shop.com", None, None, "b", "")


# --- user functions -------------------------------------------------------------------------


def test_native_and_python_forms_agree(spark):
    df = spark.createDataFrame([(1.3, 0.2), (1.25, 0.35), (1.0, None), (0.8, 0.1), (0.1, 0.0), (None, 0.3)], "x double, p double")
    got = df.select(
        U.classify_revenue("x").alias("a"), U.classify_revenue_udf("x").alias("b"), U.margin("x", "p").alias("c"), U.margin_udf("x", "p").alias("d")
    ).collect()
    assert [r.a for r in got[:5]] == [r.b for r in got[:5]] == ["HIGH", "HIGH", "MEDIUM", "LOW", "VERY LOW"]
    nan_free = lambda v: None if v is None or v != v else v
    assert [nan_free(r.c) for r in got] == [nan_free(r.d) for r in got]


def test_split_rows(spark, rows):
    df = spark.createDataFrame([(1, "red,  blue"), (2, None), (3, "a.b")], "id int, tags string")
    want = [(1, "blue", 1), (1, "red", 0), (3, "a.b", 0)]
    assert rows(U.split_rows(df, "tags", ","), "id", "item", "position") == want
    U.register(spark)
    sql = "SELECT p.id, s.item, s.position FROM {p} p, LATERAL split_to_rows(p.tags, ',') s"
    assert rows(spark.sql(sql, p=df)) == want
    assert rows(U.split_rows(df.where("id = 3"), "tags", "."), "item") == [("a",), ("b",)]  # a dot is no pattern


# --- semi-structured ------------------------------------------------------------------------


@pytest.fixture
def docs(spark):
    texts = [
        '{"ship":"Ara","legs":[{"port":"Cork","days":2},{"port":"Vigo","days":0.5},{"port":"Faro","days":7,"crew":["mo"]}]}',
        '{"ship":"Bly","cargo":["salt"],"hull":{"year":1987,"builder":{"yard":"K","no":4},"decks":["a","b"]}}',
        '{"ship":"Cid","legs":[]}',
        '{"ship":"Dov","legs":[{"port":"Oban","crew":["ty","al","jo"]}]}',
    ]
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("v"))


def test_flatten(docs, rows):
    ship = V.at("v", "ship")
    assert rows(V.flatten(docs, "v", "legs"), ship, V.at("f_value", "port"), "f_path") == [
        ("Ara", "Cork", "legs[0]"), ("Ara", "Faro", "legs[2]"), ("Ara", "Vigo", "legs[1]"), ("Dov", "Oban", "legs[0]"),
    ]
    outer = V.flatten(docs, "v", "legs", outer=True)
    assert rows(outer, ship) == [("Ara",), ("Ara",), ("Ara",), ("Bly",), ("Cid",), ("Dov",)]
    crew = V.flatten(V.flatten(docs, "v", "legs", prefix="i"), "i_value", "crew", outer=True, prefix="t")
    assert rows(crew, ship, F.try_variant_get("t_value", "$", "string")) == [
        ("Ara", None), ("Ara", None), ("Ara", "mo"), ("Dov", "al"), ("Dov", "jo"), ("Dov", "ty"),
    ]
    assert rows(V.flatten(docs, "v", "hull"), "f_key", "f_path") == [("builder", "hull.builder"), ("decks", "hull.decks"), ("year", "hull.year")]


def test_types_and_sizes(docs):
    got = docs.where(V.at("v", "ship") == "Bly").select(
        *[V.type_of(V.at("v", p, "variant")) for p in ("ship", "hull", "hull.builder.no", "hull.decks", "nothing")],
        V.array_size("v", "hull.decks"), V.array_size("v", "legs"),
    ).first()
    assert tuple(got) == ("VARCHAR", "OBJECT", "INTEGER", "ARRAY", None, 2, None)


def test_objects_and_slices(spark):
    r = one(
        spark,
        a=V.build_object({"n": F.lit("t"), "v": F.lit(None).cast("int")}),
        b=V.build_object({"n": F.lit("t"), "v": F.lit(None).cast("int")}, keep_null=True),
        c=V.array_slice(F.array(F.lit(1), F.lit(2), F.lit(3)), 0, 2),
    )
    assert (r.a, r.b, r.c) == ('{"n":"t"}', '{"n":"t","v":null}', [1, 2])


# --- learning -------------------------------------------------------------------------------


def test_classifier_accuracy(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS x, CAST(id % 7 AS DOUBLE) AS y FROM range(600)").withColumn(
        "cls", F.when(F.col("x") >= 400, "HIGH").when(F.col("x") >= 200, "MEDIUM").otherwise("LOW")
    )
    out = L.predict(df, L.fit_classifier(df, ["x", "y"], "cls"))
    assert out.where("cls = predicted_class").count() / 600 > 0.95
    p = out.select((F.col("p_high") + F.col("p_low") + F.col("p_medium")).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert p[0] == pytest.approx(1) and p[1] == pytest.approx(1)


def test_insights(spark):
    df = spark.createDataFrame(
        [("a", "n", "before", 10.0), ("a", "n", "after", 30.0), ("b", "n", "before", 5.0), ("b", "s", "after", 5.0), ("b", "s", "other", 99.0)],
        "cat string, region string, period string, m double",
    )
    got = {(r.cat, r.region): (r.before_value, r.after_value, r.share_pct) for r in L.top_insights(df, ["cat", "region"], "m", "period", "before", "after").collect()}
    assert got[("ALL", "ALL")] == (15.0, 35.0, 100.0) and got[("a", "ALL")] == (10.0, 30.0, 100.0)
    assert got[("b", "n")] == (5.0, 0.0, -25.0) and got[("b", "s")] == (0.0, 5.0, 25.0) and len(got) == 8
    assert L.top_insights(df, ["cat", "region"], "m", "period", "before", "after", n=3).count() == 3
