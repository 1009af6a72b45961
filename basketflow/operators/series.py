"""Ordered-series operators: lags, seasonal adjustment, moving-average model, backtest, tests.

A series has one row per period (day or month), so a window over a series is bounded by the
calendar, never by the size of the feed. Many series run side by side, keyed by series_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.functions.numeric import normal_quantile, pct_change

SERIES = ["series_id"]
MIN_POINTS = 12


def _ordered():
    return W.partitionBy("series_id").orderBy("date")


def prepare(series: DataFrame, target: str = "value") -> DataFrame:
    """(series_id, date, value, pos, n) without missing values; pos counts from 0."""
    if target not in series.columns:
        raise ValueError(f"column '{target}' not found in data")
    if "series_id" not in series.columns:
        series = series.withColumn("series_id", F.lit("all"))
    value = F.col(target).cast("double")
    rows = series.where(value.isNotNull() & ~F.isnan(value)).select("series_id", F.to_date("date").alias("date"), value.alias("value"))
    return rows.withColumn("pos", F.row_number().over(_ordered()) - 1).withColumn(
        "n", F.count(F.lit(1)).over(W.partitionBy("series_id"))
    )


def long_enough(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("n") >= MIN_POINTS)


def too_short(prepared: DataFrame) -> DataFrame:
    """Series that cannot be forecast, with their lengths."""
    return prepared.where(F.col("n") < MIN_POINTS).select("series_id", F.col("n").alias("points")).distinct()


def row_lag_change(series: DataFrame, rows: int = 365) -> DataFrame:
    """Percent change against the value `rows` rows earlier; NULL for the first ones."""
    return series.withColumn("change", pct_change(F.col("value"), F.lag("value", rows).over(_ordered())))


def profile(prepared: DataFrame) -> DataFrame:
    """(series_id, last_date, freq, level, sd) in one aggregate.

    freq is 'D' when all steps are one day, else 'MS'; level is the mean of the last 12 points,
    sd the sample deviation of all.
    """
    recent = F.col("pos") >= F.col("n") - MIN_POINTS
    return (
        prepared.withColumn("step", F.date_diff("date", F.lag("date").over(_ordered())))
        .groupBy("series_id")
        .agg(
            F.max("date").alias("last_date"),
            F.when((F.min("step") == 1) & (F.max("step") == 1), "D").otherwise("MS").alias("freq"),
            F.avg(F.when(recent, F.col("value"))).alias("level"),
            F.stddev_samp("value").alias("sd"),
        )
    )


def future_date(last_date: Column, freq: Column, step: Column) -> Column:
    """Date of a forecast step: next days, or next month starts."""
    month = F.add_months(F.trunc(last_date, "month"), step)
    return F.when(freq == "D", F.date_add(last_date, step)).otherwise(month)


def future_axis(profiles: DataFrame, horizon: int) -> DataFrame:
    """Profiles with one row per step after the last point: `step` and its `date`."""
    return profiles.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "date", future_date(F.col("last_date"), F.col("freq"), F.col("step"))
    )


def moving_average_forecast(prepared: DataFrame, horizon: int = 12, confidence: float = 0.95) -> DataFrame:
    """Flat forecast at the mean of the last 12 points with a normal band."""
    half = F.col("sd") * normal_quantile(confidence)
    return future_axis(profile(long_enough(prepared)), horizon).select(
        "series_id",
        F.col("step").cast("bigint").alias("step"),
        "date",
        F.col("level").alias("forecast"),
        (F.col("level") - half).alias("lower"),
        (F.col("level") + half).alias("upper"),
        F.lit("moving_average").alias("model"),
    )


def fold_filter(test_size: int, step_size: int) -> Column:
    """Positions that a rolling-origin backtest predicts."""
    back = F.col("n") - F.col("pos")
    return (back <= test_size) & ((test_size - back) % step_size == 0) & (F.col("pos") >= MIN_POINTS)


def moving_average_folds(
    prepared: DataFrame, test_size: int = 12, step_size: int = 1, confidence: float = 0.95
) -> DataFrame:
    """(series_id, pos, date, actual, predicted, lower, upper): one-step forecasts from all earlier points."""
    last12 = _ordered().rowsBetween(-MIN_POINTS, -1)
    before = _ordered().rowsBetween(W.unboundedPreceding, -1)
    half = F.col("sd") * normal_quantile(confidence)
    return (
        long_enough(prepared)
        .withColumns({"predicted": F.avg("value").over(last12), "sd": F.stddev_samp("value").over(before)})
        .where(fold_filter(test_size, step_size))
        .select(
            "series_id",
            "pos",
            "date",
            F.col("value").alias("actual"),
            "predicted",
            (F.col("predicted") - half).alias("lower"),
            (F.col("predicted") + half).alias("upper"),
        )
    )


def test_period(prepared: DataFrame, test_size: int = 12) -> DataFrame:
    """(series_id, test_period_start, test_period_end): the last `test_size` points."""
    return (
        long_enough(prepared)
        .where(F.col("pos") >= F.col("n") - test_size)
        .groupBy("series_id")
        .agg(F.min("date").alias("test_period_start"), F.max("date").alias("test_period_end"))
    )


def backtest_metrics(folds: DataFrame, period: DataFrame) -> DataFrame:
    """One row per series of `period`: test period and six metrics; zeros below two folds."""
    by_pos = W.partitionBy("series_id").orderBy("pos")
    turn = F.signum(F.col("actual") - F.lag("actual").over(by_pos)) == F.signum(
        F.col("predicted") - F.lag("predicted").over(by_pos)
    )
    error = F.col("actual") - F.col("predicted")
    metrics = {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "mape": F.coalesce(F.avg(F.when(F.col("actual") != 0, F.abs(error / F.col("actual")))) * 100, F.lit(0.0)),
        "directional_accuracy": F.coalesce(F.avg(F.col("turn").cast("double")), F.lit(0.0)),
        "coverage_probability": F.avg(F.col("actual").between(F.col("lower"), F.col("upper")).cast("double")),
        "forecast_bias": F.avg(error),
    }
    rows = (
        folds.withColumn("turn", turn)
        .groupBy("series_id")
        .agg(F.count(F.lit(1)).alias("folds"), *[v.alias(k) for k, v in metrics.items()])
    )
    return period.join(rows, "series_id", "left").select(
        "series_id",
        F.coalesce("folds", F.lit(0)).cast("bigint").alias("folds"),
        "test_period_start",
        "test_period_end",
        *[F.when(F.col("folds") >= 2, F.col(k)).otherwise(0.0).alias(k) for k in metrics],
    )


def backtest_arrays(folds: DataFrame) -> DataFrame:
    """Per series the ordered actual, predicted and error values as arrays (test_size long)."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "actual", "predicted")))
    return folds.groupBy("series_id").agg(rows.alias("r")).select(
        "series_id",
        F.col("r.actual").alias("actual_values"),
        F.col("r.predicted").alias("predicted_values"),
        F.transform("r", lambda x: x["actual"] - x["predicted"]).alias("errors"),
    )


def ljung_box(residuals: DataFrame, lags: int = 10) -> DataFrame:
    """Per series: n, Q at `lags` and its p-value. `lags` must be even (closed form of the chi-square tail)."""
    if lags % 2:
        raise ValueError("lags must be even")
    centred = residuals.withColumn("e", F.col("value") - F.avg("value").over(W.partitionBy("series_id")))
    products = {k: F.col("e") * F.lag("e", k).over(_ordered()) for k in range(1, lags + 1)}
    sums = (
        centred.select("series_id", "e", *[p.alias(f"p{k}") for k, p in products.items()])
        .groupBy("series_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("e") * F.col("e")).alias("s0"), *[F.sum(f"p{k}").alias(f"s{k}") for k in products])
    )
    n = F.col("n")
    terms = [F.pow(F.try_divide(F.col(f"s{k}"), F.col("s0")), F.lit(2.0)) / (n - k) for k in products]
    q = n * (n + 2) * reduce(lambda a, b: a + b, terms)
    half, term, tail = F.col("q") / 2, F.lit(1.0), F.lit(1.0)
    for i in range(1, lags // 2):
        term = term * half / i
        tail = tail + term
    return (
        sums.where(n > lags)
        .select("series_id", "n", q.alias("q"))
        .select("series_id", "n", "q", (F.exp(-half) * tail).alias("p_value"))
    )


def moving_average_residuals(prepared: DataFrame) -> DataFrame:
    """Value minus the mean of the 12 values before it."""
    mean = F.avg("value").over(_ordered().rowsBetween(-MIN_POINTS, -1))
    return prepared.withColumn("value", F.col("value") - mean).where(F.col("pos") >= MIN_POINTS).select("series_id", "date", "value")


def seasonal_adjust(prepared: DataFrame, period: int = 12) -> DataFrame:
    """Multiplicative adjustment by a centred 2 x period moving average.

    The trend's ends are extended by straight lines over `period` points next to them. Series
    shorter than two periods come back unchanged with factor 1.
    """
    if period % 2:
        raise ValueError("an even period is expected")
    half = period // 2
    early = F.avg("value").over(_ordered().rowsBetween(-half, half - 1))
    late = F.avg("value").over(_ordered().rowsBetween(-half + 1, half))
    pos, n = F.col("pos"), F.col("n")
    has_trend = pos.between(half, n - 1 - half) & (n >= 2 * period)
    rows = prepared.withColumn("trend", F.when(has_trend, (early + late) / 2))
    first, last = half, n - 1 - half
    front = has_trend & (pos < F.least(F.lit(first + period), last))
    back = has_trend & (pos >= F.greatest(F.lit(first), last - period)) & (pos < last)
    whole, phase = W.partitionBy("series_id"), W.partitionBy("series_id", "phase")

    def line(where: Column) -> Column:
        y, x = F.when(where, F.col("trend")), F.when(where, pos.cast("double"))
        return F.regr_intercept(y, x).over(whole) + F.regr_slope(y, x).over(whole) * pos

    rows = rows.withColumns({"front": line(front), "back": line(back), "phase": pos % period})
    trend = F.when(pos < first, F.col("front")).when(pos > last, F.col("back")).otherwise(F.col("trend"))
    rows = rows.withColumn("raw", F.avg(F.try_divide(F.col("value"), trend)).over(phase))
    # Mean of the factors: each phase counts once, however many rows it has.
    rows = rows.withColumn("share", F.col("raw") / F.count(F.lit(1)).over(phase))
    seasonal = F.try_divide(F.col("raw"), F.sum("share").over(whole) / period)
    rows = rows.withColumn("seasonal", F.when(n >= 2 * period, seasonal).otherwise(1.0))
    return rows.select(
        "series_id", "date", "value", "seasonal", F.try_divide("value", "seasonal").alias("adjusted")
    )


def chart_series(prepared: DataFrame, forecast: DataFrame, historical_periods: int = 24) -> DataFrame:
    """The last points of the history and the forecast in one frame, told apart by `kind`."""
    history = prepared.where(F.col("pos") >= F.col("n") - historical_periods).select(
        "series_id", "date", F.lit("history").alias("kind"), "value"
    )
    ahead = forecast.select(
        "series_id", "date", F.lit("forecast").alias("kind"), F.col("forecast").alias("value"), "lower", "upper"
    )
    return history.unionByName(ahead, allowMissingColumns=True)


def band_outline(forecast: DataFrame) -> DataFrame:
    """Per series the outline of the band: dates there and back, upper bounds then lower ones."""
    rows = F.array_sort(F.collect_list(F.struct("date", "upper", "lower")))
    return forecast.groupBy("series_id").agg(rows.alias("r")).select(
        "series_id",
        F.concat(F.col("r.date"), F.reverse(F.col("r.date"))).alias("x"),
        F.concat(F.col("r.upper"), F.reverse(F.col("r.lower"))).alias("y"),
    )


def forecast_documents(forecast: DataFrame, extra: DataFrame, name: str = "backtest") -> DataFrame:
    """One nested row per series: model, dates, values and bounds in order, and the row of `extra`
    (backtest metrics or diagnostics) as a struct. Arrays are as long as the horizon."""
    rows = F.array_sort(F.collect_list(F.struct("step", "date", "forecast", "lower", "upper")))
    documents = forecast.groupBy("series_id").agg(F.first("model").alias("model"), rows.alias("r")).select(
        "series_id",
        "model",
        F.transform("r", lambda x: F.date_format(x["date"], "yyyy-MM-dd")).alias("dates"),
        F.col("r.forecast").alias("values"),
        F.col("r.lower").alias("confidence_lower"),
        F.col("r.upper").alias("confidence_upper"),
    )
    nested = extra.select("series_id", F.struct(*[c for c in extra.columns if c != "series_id"]).alias(name))
    return documents.join(nested, "series_id", "left")


def forecast_band_table(forecast: DataFrame, half_width: float = 1.5) -> DataFrame:
    """Month label, forecast and a fixed band around it."""
    return forecast.select(
        "series_id",
        F.date_format("date", "yyyy-MM").alias("month"),
        "forecast",
        (F.col("forecast") - half_width).alias("lower"),
        (F.col("forecast") + half_width).alias("upper"),
    )
