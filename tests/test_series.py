"""Forecasts recover what generated the data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brightledger.operators import series as S
from brightledger.sources.generators import MONTH_EFFECT, daily_sales


def test_exact_recovery_without_noise(spark):
    model = S.ts_fit(daily_sales(spark, noise=0.0), "sale_date", "daily_revenue").first()
    assert model.slope == pytest.approx(0.15, abs=1e-3)
    assert model.sigma < 0.5
    m = model.month_effect
    assert m[12] - m[1] == pytest.approx(MONTH_EFFECT[11] - MONTH_EFFECT[0], abs=0.7)
    w = model.weekday_effect
    assert w[1] - w[0] == pytest.approx(30, abs=0.5) and w[1] - w[6] == pytest.approx(30, abs=0.5)


def test_recovery_within_noise(spark):
    model = S.ts_fit(daily_sales(spark), "sale_date", "daily_revenue").first()
    assert model.slope == pytest.approx(0.15, abs=0.02)
    assert model.sigma == pytest.approx(15 / 3**0.5, rel=0.1)


def test_goals_on_the_generated_series(spark):
    row = S.ts_evaluate(daily_sales(spark, n=1460), "sale_date", "daily_revenue", 90).first()
    assert row.n == 90 and row.mape < 10 and row.coverage > 90


def test_keys_give_the_same_model_as_single_series(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    many = daily_sales(spark, n=200, keys=keys)
    both = {r.k: r for r in S.ts_fit(many, "sale_date", "daily_revenue", ["k"]).collect()}
    alone = S.ts_fit(many.where("k = 'a'").drop("k"), "sale_date", "daily_revenue").first()
    assert both["a"].slope == pytest.approx(alone.slope) and both["a"].sigma == pytest.approx(alone.sigma)
    assert both["a"].slope != both["b"].slope
    ahead = S.ts_forecast(S.ts_fit(many, "sale_date", "daily_revenue", ["k"]), 10, 0.9, ["k"])
    assert ahead.groupBy("k").count().orderBy("k").collect() == [("a", 10), ("b", 10)]


def test_short_series_keep_every_row(spark):
    """29 days, one day, and a series of NULLs: a model as far as the rows go, and every row in the result."""
    short = daily_sales(spark, n=29).withColumn("k", F.lit("short"))
    one = daily_sales(spark, n=1).withColumn("k", F.lit("one"))
    none = daily_sales(spark, n=3).withColumn("daily_revenue", F.lit(None).cast(short.schema["daily_revenue"].dataType)).withColumn("k", F.lit("none"))
    rows = short.unionByName(one).unionByName(none)
    model = S.ts_fit(rows, "sale_date", "daily_revenue", ["k"])
    assert {r.k: r.n_rows for r in model.collect()} == {"short": 29, "one": 1}
    got = S.ts_anomaly(rows, model, "sale_date", "daily_revenue", ["k"]).collect()
    assert len(got) == 33
    by = {k: [r for r in got if r.k == k] for k in ("short", "one", "none")}
    assert all(r.lower_bound < r.forecast < r.upper_bound for r in by["short"])
    assert by["one"][0].forecast == pytest.approx(by["one"][0].actual) and by["one"][0].lower_bound is None
    assert all(r.forecast is None and r.is_anomaly is None for r in by["none"])
    assert S.ts_anomaly(none, S.ts_fit(none, "sale_date", "daily_revenue"), "sale_date", "daily_revenue").count() == 3


@pytest.mark.parametrize("share, z", [(0.5, 0.67449), (0.8, 1.28155), (0.977, 2.27343)])
def test_any_interval_width(share, z):
    assert S.quantile(share) == pytest.approx(z, abs=1e-5)
    with pytest.raises(ValueError):
        S.quantile(share + 1)


def test_missing_days_and_nulls(spark):
    df = daily_sales(spark, noise=0.0).withColumn(
        "daily_revenue", F.when(F.dayofmonth("sale_date") % 7 != 0, F.col("daily_revenue"))
    )
    model = S.ts_fit(df, "sale_date", "daily_revenue").first()
    assert model.slope == pytest.approx(0.15, abs=1e-3) and model.n_rows < 730


def test_constant_series(spark):
    df = daily_sales(spark, n=60).withColumn("daily_revenue", F.lit(7.0))
    rows = S.ts_forecast(S.ts_fit(df, "sale_date", "daily_revenue"), 3).collect()
    assert [round(r.forecast, 6) for r in rows] == [7.0] * 3
    assert [str(r.ts) for r in rows] == ["2023-03-02", "2023-03-03", "2023-03-04"]


def test_wider_interval_for_more_coverage(spark):
    model = S.ts_fit(daily_sales(spark), "sale_date", "daily_revenue")
    width = lambda p: S.ts_forecast(model, 1, p).selectExpr("upper_bound - lower_bound AS w").first().w
    assert width(0.9) < width(0.95) < width(0.99)


def test_anomaly_finds_a_planted_day(spark):
    day = dt.date(2024, 3, 13)
    df = daily_sales(spark).withColumn(
        "daily_revenue", F.when(F.col("sale_date") == F.lit(day), F.lit(900.0)).otherwise(F.col("daily_revenue"))
    )
    flagged = S.ts_anomaly(df, S.ts_fit(df, "sale_date", "daily_revenue"), "sale_date", "daily_revenue").where("is_anomaly")
    assert [r.ts for r in flagged.collect()] == [day]


def test_backtest_equals_an_evaluation_of_every_cut_off(spark):
    """Folds that overlap and folds apart, with and without keys, against a model of its own for each."""
    df = daily_sales(spark, n=400).unionByName(daily_sales(spark, n=400).where("sale_date < '2023-01-10'").limit(0))
    last = df.agg(F.max("sale_date")).first()[0]
    for holdout, folds, step in ((30, 3, 30), (40, 4, 15), (10, 2, 60)):
        got = {r.fold: r for r in S.ts_backtest(df, "sale_date", "daily_revenue", holdout, folds, step).collect()}
        assert set(got) == set(range(folds))
        for k in range(folds):
            cut = F.date_sub(F.lit(last), holdout + (folds - 1 - k) * step)
            part = df.where(F.col("sale_date") <= F.date_add(cut, holdout))
            one = S.ts_evaluate(part, "sale_date", "daily_revenue", holdout).first()
            assert all(getattr(got[k], c) == getattr(one, c) for c in ("n", "mape", "mae", "mse", "rmse", "coverage"))
    both = df.withColumn("k", F.lit("a")).unionByName(df.withColumn("k", F.lit("b")).where(F.col("sale_date") < F.date_sub(F.lit(last), 45)))
    keyed = {(r.k, r.fold): r.mape for r in S.ts_backtest(both, "sale_date", "daily_revenue", 20, 2, keys=["k"]).collect()}
    alone = {r.fold: r.mape for r in S.ts_backtest(df, "sale_date", "daily_revenue", 20, 2).collect()}
    assert {f: m for (k, f), m in keyed.items() if k == "a"} == alone and len(keyed) == 4


def test_predictions_come_out(spark):
    from brightledger.plans.catalog import REGISTRY

    rows = REGISTRY["ml_classify_predictions"](spark, "/root/testdata/sf0.01").collect()
    names = [c for c in rows[0].asDict() if c.startswith("p_")]
    assert len(rows) > 100 and len(names) >= 3
    right = 0
    for r in rows:
        shares = {c: r[c] for c in names}
        assert abs(sum(shares.values()) - 1) < 1e-9 and shares[f"p_{r.predicted_class.lower()}"] == max(shares.values())
        right += r.predicted_class == r.revenue_class
    assert right >= 0.9 * len(rows)
