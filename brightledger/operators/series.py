"""Forecasts, their evaluation, and anomalies for daily series.

The model is additive: level + slope * day + month effect + weekday effect, with one residual
deviation. One scan of the rows gives, per series, at most 84 (month, weekday) cells with exact
sums; everything after that works on the cells. The slope is fitted within the cells, so the
season cannot leak into it; the effects come from alternating weighted means. Scores of a hosted
forecaster are not reproduced, only its inputs and outputs.

A frame holds one row per (keys, date). ``keys=[]`` is one series.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import dbl, r2, ratio, round_half_up
from .layout import stored

EPOCH = "2000-01-01"
PASSES = 3
# Fixed value: name of the forecast quality row.
ASSESSMENT = "Forecast Model Performance"


def _day(ts: str) -> Column:
    return F.datediff(F.col(ts), F.lit(EPOCH).cast("date"))


SUMS = ("n", "sx", "sxx", "sy", "sxy", "syy")


def _exact_cells(df: DataFrame, ts: str, value: str, keys: Sequence[Column | str], decimals: int) -> DataFrame:
    """Exact sums of each (keys, month, weekday)."""
    x = _day(ts).cast("bigint")
    y = F.col(value).cast(f"decimal(18,{decimals})")
    return (
        df.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
        .groupBy(*keys, F.month(ts).alias("m"), D.dow0(ts).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(x).alias("sx"),
            F.sum(x * x).alias("sxx"),
            F.sum(y).alias("sy"),
            F.sum(x.cast("decimal(10,0)") * y).alias("sxy"),
            F.sum(y * y).alias("syy"),
            F.max(ts).alias("last"),
        )
    )


def _as_doubles(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.select(*keys, "m", "w", "last", *[dbl(c).alias(c) for c in SUMS])


def ts_fit(df: DataFrame, ts: str, value: str, keys: Sequence[str] = (), decimals: int = 2) -> DataFrame:
    """One model row per series: slope, level, month and weekday effects (as maps), deviation, rows, last date.

    Values are read to ``decimals`` places, so that their sums are exact. Missing days are allowed. A short series is
    fitted as far as its rows go: on one day the slope is 0, and with one row there is no deviation. Only a
    series without any value has no model.
    """
    return _fit(_as_doubles(_exact_cells(df, ts, value, keys, decimals), keys), keys)


def _fit(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Models from cells."""
    # All windows below partition by the keys or finer, so this is their only shuffle.
    cells = cells.repartition(*keys) if keys else cells.coalesce(1)
    whole, by_m, by_w = W.partitionBy(*keys), W.partitionBy(*keys, "m"), W.partitionBy(*keys, "w")
    total = lambda c: F.sum(c).over(whole)

    within = ratio(
        total(F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")),
        total(F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")),
    )
    n, sx = total("n"), total("sx")
    overall = ratio(total("sxy") - sx * total("sy") / n, total("sxx") - sx * sx / n)
    fit = cells.withColumn("slope", F.coalesce(within, overall, F.lit(0.0)))
    fit = fit.withColumn("level", total(F.col("sy") - F.col("slope") * F.col("sx")) / n)
    fit = fit.withColumn("res", F.col("sy") - F.col("slope") * F.col("sx") - F.col("n") * F.col("level"))
    fit = fit.withColumn("b", F.lit(0.0))
    for _ in range(PASSES):
        fit = fit.withColumn("a", F.sum(F.col("res") - F.col("n") * F.col("b")).over(by_m) / F.sum("n").over(by_m))
        fit = fit.withColumn("b", F.sum(F.col("res") - F.col("n") * F.col("a")).over(by_w) / F.sum("n").over(by_w))
    e, s = F.col("level") + F.col("a") + F.col("b"), F.col("slope")
    square = (
        F.col("syy") - 2 * s * F.col("sxy") + s * s * F.col("sxx")
        - 2 * e * (F.col("sy") - s * F.col("sx")) + F.col("n") * e * e
    )
    rows = F.sum("n")
    return (
        fit.withColumn("square", square)
        .groupBy(*keys)
        .agg(
            F.first("slope").alias("slope"),
            F.first("level").alias("level"),
            F.map_from_entries(F.collect_set(F.struct("m", "a"))).alias("month_effect"),
            F.map_from_entries(F.collect_set(F.struct("w", "b"))).alias("weekday_effect"),
            F.sqrt(F.greatest(F.sum("square"), F.lit(0.0)) / F.nullif(rows - 1, F.lit(0.0))).alias("sigma"),
            rows.cast("bigint").alias("n_rows"),
            F.max("last").alias("last_date"),
        )
    )


def _point(date: str) -> Column:
    """Model value on a date; a month or weekday never seen adds nothing."""
    effect = lambda name, key: F.coalesce(F.try_element_at(F.col(name), key), F.lit(0.0))
    return (
        F.col("level") + F.col("slope") * _day(date)
        + effect("month_effect", F.month(date)) + effect("weekday_effect", D.dow0(date))
    )


def quantile(prediction_interval: float) -> float:
    """How many deviations either side of the mean hold this share of a normal distribution."""
    if not 0 < prediction_interval < 1:
        raise ValueError("prediction interval must lie between 0 and 1")
    return NormalDist().inv_cdf((1 + prediction_interval) / 2)


def _z(prediction_interval: float) -> Column:
    return F.lit(quantile(prediction_interval))


def ts_forecast(
    model: DataFrame, periods: int, prediction_interval: float = 0.95, keys: Sequence[str] = ()
) -> DataFrame:
    """Point, lower and upper value for the days after the last one of each series."""
    days = model.withColumn(
        "ts", F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", periods)))
    )
    half = _z(prediction_interval) * F.col("sigma")
    return days.withColumn("forecast", _point("ts")).select(
        *keys, "ts", "forecast",
        (F.col("forecast") - half).alias("lower_bound"),
        (F.col("forecast") + half).alias("upper_bound"),
    )


def ts_fitted(df: DataFrame, model: DataFrame, ts: str, value: str, keys: Sequence[str], prediction_interval: float) -> DataFrame:
    """Every actual row beside the model's value and bounds for its date, NULL where there are none."""
    if keys:
        rows = df.join(model, list(keys), "left")
    else:
        one = model.select(F.struct(*[F.col(c) for c in model.columns])).scalar()
        rows = df.withColumn("_m", one).select(*df.columns, "_m.*")
    half = _z(prediction_interval) * F.col("sigma")
    return rows.withColumn("forecast", _point(ts)).select(
        *keys, F.col(ts).alias("ts"), dbl(value).alias("actual"), "forecast",
        (F.col("forecast") - half).alias("lower_bound"),
        (F.col("forecast") + half).alias("upper_bound"),
    )


def ts_evaluate(
    df: DataFrame, ts: str, value: str, holdout: int, keys: Sequence[str] = (), prediction_interval: float = 0.95
) -> DataFrame:
    """MAPE, MAE, MSE, RMSE and coverage in percent, on the last ``holdout`` days, from a model of the days before."""
    return ts_backtest(df, ts, value, holdout, 1, keys=keys, prediction_interval=prediction_interval).drop("fold", "cutoff")


def ts_backtest(
    df: DataFrame, ts: str, value: str, holdout: int, folds: int, step: int | None = None, keys: Sequence[str] = (),
    prediction_interval: float = 0.95, decimals: int = 2,
) -> DataFrame:
    """Rolling-origin evaluation: per fold, scores on the ``holdout`` days after its cut-off, from a model of all days up to it.

    The last fold's cut-off lies ``holdout`` days before the end of the series, each earlier one ``step`` days (by default ``holdout``) before the next. The rows are stored once,
    so whatever makes them runs once. One pass sums them to cells of the stretch between two cut-offs; the cells of a fold's model are the sums over all stretches up to its
    cut-off, so k folds cost one pass over the rows and not 2k.
    """
    if folds < 1 or holdout < 1 or (step is not None and step < 1):
        raise ValueError("folds, holdout and step must be 1 at least")
    step = step or holdout
    keys = list(keys)
    rows = stored(df.select(*keys, F.col(ts).alias("_ts"), F.col(value).alias("_v")), "series")
    if keys:
        rows = rows.join(rows.groupBy(*keys).agg(F.max("_ts").alias("_last")), keys)
    else:
        rows = rows.withColumn("_last", rows.select(F.max("_ts")).scalar())
    # Days after the first cut-off.
    after = F.datediff("_ts", F.date_sub("_last", holdout + (folds - 1) * step))
    stretch = F.greatest(F.lit(0), F.ceil(after / step)).cast("int")
    pieces = _exact_cells(rows.withColumn("_s", stretch).where(F.col("_s") < folds), "_ts", "_v", [*keys, "_s"], decimals)
    upto = pieces.withColumn("fold", F.explode(F.sequence("_s", F.lit(folds - 1)))).groupBy(*keys, "fold", "m", "w").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("last").alias("last")
    )
    model = _fit(_as_doubles(upto, [*keys, "fold"]), [*keys, "fold"])
    # A day is tested by the folds whose cut-off lies at most ``holdout`` days before it.
    first = F.greatest(F.lit(0), F.ceil((after - holdout) / step)).cast("int")
    final = F.least(F.lit(folds - 1), (F.ceil(after / step) - 1).cast("int"))
    test = rows.where(after >= 1).withColumns({"_f": first, "_t": final}).where(F.col("_f") <= F.col("_t"))
    test = test.select(*keys, "_ts", "_v", "_last", F.explode(F.sequence("_f", "_t")).alias("fold"))
    met = F.col("r.fold") == F.col("m.fold")
    for k in keys:
        met = met & F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}"))
    half = _z(prediction_interval) * F.col("sigma")
    scored = (
        test.alias("r").join(model.alias("m"), met, "left")
        .select("r.*", *[F.col(f"m.{c}") for c in model.columns if c not in [*keys, "fold"]])
        .withColumn("forecast", _point("_ts"))
        .select(*keys, "fold", "_last", dbl("_v").alias("actual"), "forecast", (F.col("forecast") - half).alias("lower_bound"), (F.col("forecast") + half).alias("upper_bound"))
    )
    miss = F.col("actual") - F.col("forecast")
    inside = F.col("actual").between(F.col("lower_bound"), F.col("upper_bound"))
    n = F.count(F.lit(1))
    return scored.groupBy(*keys, "fold").agg(
        F.date_sub(F.max("_last"), F.lit(holdout) + (F.lit(folds - 1) - F.col("fold")) * step).alias("cutoff"),
        n.alias("n"),
        round_half_up(F.sum(F.abs(miss / F.nullif(F.col("actual"), F.lit(0.0)))) / n * 100, 4).alias("mape"),
        r2(F.sum(F.abs(miss)) / n).alias("mae"),
        F.round(F.sum(miss * miss) / n, 0).alias("mse"),
        r2(F.sqrt(F.sum(miss * miss) / n)).alias("rmse"),
        round_half_up(ratio(F.count_if(inside) * 100, n), 2).alias("coverage"),
    )


def ts_anomaly(
    df: DataFrame, model: DataFrame, ts: str, value: str, keys: Sequence[str] = (), prediction_interval: float = 0.99
) -> DataFrame:
    """Every row with the model's value and bounds, and whether it lies outside them (NULL without bounds)."""
    rows = ts_fitted(df, model, ts, value, keys, prediction_interval)
    outside = ~F.col("actual").between(F.col("lower_bound"), F.col("upper_bound"))
    return rows.withColumn("is_anomaly", outside)


# --- forecast tables and reports ------------------------------------------------------------


def forecast_table(model: DataFrame, periods: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rounded forecast with the width of its 95 % interval."""
    return ts_forecast(model, periods, 0.95, keys).select(
        *keys,
        F.col("ts").alias("forecast_date"),
        r2("forecast").alias("forecasted_revenue"),
        r2("lower_bound").alias("lower_bound_95pct"),
        r2("upper_bound").alias("upper_bound_95pct"),
        r2(F.col("upper_bound") - F.col("lower_bound")).alias("confidence_interval_width"),
    )


def combined(daily: DataFrame, table: DataFrame) -> DataFrame:
    """Actual and forecast rows in one frame; days ahead count from the last actual day."""
    last = daily.select(F.max("sale_date")).scalar()
    none = F.lit(None).cast("double")
    actual = daily.select(
        F.col("sale_date").alias("date"), dbl("daily_revenue").alias("actual_revenue"),
        none.alias("forecast_revenue"), none.alias("lower_bound"), none.alias("upper_bound"),
        F.lit("ACTUAL").alias("data_type"), F.lit(None).cast("int").alias("days_ahead"),
    )
    ahead = table.select(
        F.col("forecast_date").alias("date"), none.alias("actual_revenue"),
        F.col("forecasted_revenue").alias("forecast_revenue"), F.col("lower_bound_95pct").alias("lower_bound"),
        F.col("upper_bound_95pct").alias("upper_bound"),
        F.lit("FORECAST").alias("data_type"), F.datediff("forecast_date", last).alias("days_ahead"),
    )
    return actual.unionByName(ahead)


def transition(both: DataFrame, days_before: int, as_of: Column) -> DataFrame:
    """Rows from some days before a date on."""
    return both.where(F.col("date") >= F.date_sub(as_of, days_before))


def monthly_summary(table: DataFrame) -> DataFrame:
    f, d = "forecasted_revenue", "forecast_date"
    c = lambda name: F.col(name).cast("decimal(20,2)")
    mean = lambda name: r2(ratio(F.sum(c(name)), F.count(F.lit(1))))
    return table.groupBy(
        D.month_start(d).alias("month_date"), F.year(d).alias("year"), F.month(d).alias("month")
    ).agg(
        F.count(F.lit(1)).alias("forecast_days"),
        dbl(F.sum(c(f))).alias("total_forecasted_revenue"),
        mean(f).alias("avg_daily_forecast"),
        F.min(f).alias("min_daily_forecast"),
        F.max(f).alias("max_daily_forecast"),
        mean("lower_bound_95pct").alias("avg_lower_bound"),
        mean("upper_bound_95pct").alias("avg_upper_bound"),
    )


def quality_summary(table: DataFrame) -> DataFrame:
    c = lambda name: F.col(name).cast("decimal(20,2)")
    n = F.count(F.lit(1))
    return table.agg(
        n.alias("forecast_records"),
        r2(ratio(F.sum(c("confidence_interval_width")), n)).alias("avg_confidence_width"),
        dbl(F.sum(c("forecasted_revenue"))).alias("total_forecast"),
        r2(ratio(F.sum(c("forecasted_revenue")), n)).alias("avg_daily_forecast"),
    ).select(F.lit(ASSESSMENT).alias("assessment"), "*")


def uncertainty(table: DataFrame, days: int = 30) -> DataFrame:
    """Interval width as percent of the forecast, over the first days."""
    first = table.select(F.min("forecast_date")).scalar()
    return table.where(F.col("forecast_date") < F.date_add(first, days)).select(
        "*", r2(ratio("confidence_interval_width", "forecasted_revenue") * 100).alias("uncertainty_pct")
    )


def scenarios(table: DataFrame) -> DataFrame:
    """Worst, base and best case per month from the bounds."""
    total = lambda name: dbl(F.sum(F.col(name).cast("decimal(20,2)")))
    return table.groupBy(D.month_start("forecast_date").alias("month")).agg(
        total("lower_bound_95pct").alias("worst_case"),
        total("forecasted_revenue").alias("base_case"),
        total("upper_bound_95pct").alias("best_case"),
    )
