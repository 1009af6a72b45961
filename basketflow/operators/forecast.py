"""Forecasts of fitted models with their bands, backtests and diagnostics; moving averages where no model can be fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import ForecastConfig
from basketflow.functions.numeric import normal_quantile
from basketflow.operators import arima, series, smoothing
from basketflow.session import stored

BAND = ["forecast", "lower", "upper"]


def _rows(prepared: DataFrame, found: DataFrame, horizon: int, confidence: float, name: str) -> DataFrame:
    """The found (series_id, step, forecast, se) with dates and bands; series without any get the moving average."""
    half = F.col("se") * normal_quantile(confidence)
    axis = series.future_axis(series.profile(prepared), horizon).select("series_id", F.col("step").cast("bigint").alias("step"), "date")
    rows = axis.join(found, ["series_id", "step"]).select(
        "series_id", "step", "date", "forecast", (F.col("forecast") - half).alias("lower"), (F.col("forecast") + half).alias("upper"), F.lit(name).alias("model")
    )
    rest = prepared.join(found.select("series_id").distinct(), "series_id", "left_anti")
    return rows.unionByName(series.moving_average_forecast(rest, horizon, confidence))


def arima_models(prepared: DataFrame, cfg: ForecastConfig, keys: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """Fitted models of all series that can be solved, stored: order and differences by test and search, or as configured."""
    season = cfg.seasonal_period if any(cfg.seasonal_order) else 0
    if cfg.auto_order:
        models = arima.fitted(prepared, arima.adf(prepared, keys), keys, season)
    else:
        p, d, q = cfg.arima_order
        models = arima.fitted(prepared, d, keys, season, [(p, q)])
    return stored(models, "arima-models")


def arima_forecast(prepared: DataFrame, cfg: ForecastConfig, models: DataFrame | None = None) -> DataFrame:
    """series_id, step, date, forecast, lower, upper, model."""
    prepared = series.long_enough(prepared)
    found = arima.ahead(models or arima_models(prepared, cfg), cfg.horizon)
    steps = found.select("series_id", F.posexplode(F.arrays_zip("forecast", "se")).alias("at", "v"))
    steps = steps.select("series_id", (F.col("at") + 1).cast("bigint").alias("step"), "v.forecast", "v.se")
    return _rows(prepared, steps, cfg.horizon, cfg.confidence_level, "arima")


def ets_forecast(prepared: DataFrame, cfg: ForecastConfig, models: DataFrame | None = None) -> DataFrame:
    """series_id, step, date, forecast, lower, upper, model."""
    prepared = series.long_enough(prepared)
    models = models or smoothing.fitted(prepared, period=cfg.seasonal_period)
    steps = models.withColumn("step", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(cfg.horizon).cast("bigint"))))
    value, error = smoothing.ahead(steps, F.col("step"), cfg.seasonal_period)
    return _rows(prepared, steps.select("series_id", "step", value.alias("forecast"), error.alias("se")), cfg.horizon, cfg.confidence_level, "ets")


def ensemble_forecast(prepared: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Mean of both models' forecasts and of their bounds, step by step."""
    both = arima_forecast(prepared, cfg).unionByName(ets_forecast(prepared, cfg))
    means = both.groupBy("series_id", "step", "date").agg(*[F.avg(c).alias(c) for c in BAND])
    return means.withColumn("model", F.lit("ensemble"))


def forecast(prepared: DataFrame, cfg: ForecastConfig | None = None) -> DataFrame:
    """Forecast of the configured model type; `ensemble` may be an alias of ARIMA."""
    cfg = cfg or ForecastConfig()
    prepared = stored(prepared, "prepared")
    if cfg.model_type == "arima" or (cfg.model_type == "ensemble" and cfg.ensemble_is_arima):
        return arima_forecast(prepared, cfg)
    return ets_forecast(prepared, cfg) if cfg.model_type == "ets" else ensemble_forecast(prepared, cfg)


def backtest_folds(prepared: DataFrame, cfg: ForecastConfig | None = None, test_size: int = 12, step_size: int = 1) -> DataFrame:
    """(series_id, pos, date, actual, predicted, lower, upper): one-step forecasts of models fitted to all earlier points.

    Every training part is a series of its own, so all folds of all series are fitted side by side in one job. Folds that can't be fitted take the
    moving average.
    """
    cfg = cfg or ForecastConfig()
    prepared = stored(series.long_enough(prepared), "prepared")
    parts = stored(arima.expanding(prepared, test_size, step_size, series.MIN_POINTS), "training-parts")
    keys = ("series_id", "cut")
    if cfg.model_type == "ets":
        models = smoothing.fitted(parts, keys, cfg.seasonal_period)
        value, error = smoothing.ahead(models, F.lit(1), cfg.seasonal_period)
        found = models.select(*keys, value.alias("predicted"), error.alias("se"))
    else:
        ahead = arima.ahead(arima_models(parts, cfg, keys), 1)
        found = ahead.select(*keys, F.element_at("forecast", 1).alias("predicted"), F.element_at("se", 1).alias("se"))
    half = F.col("se") * normal_quantile(cfg.confidence_level)
    actual = prepared.select("series_id", "pos", "date", F.col("value").alias("actual"))
    fitted = actual.join(found.withColumnRenamed("cut", "pos"), ["series_id", "pos"]).select(
        "series_id", "pos", "date", "actual", "predicted", (F.col("predicted") - half).alias("lower"), (F.col("predicted") + half).alias("upper")
    )
    plain = series.moving_average_folds(prepared, test_size, step_size, cfg.confidence_level)
    return fitted.unionByName(plain.join(fitted.select("series_id", "pos"), ["series_id", "pos"], "left_anti"))


def backtest(prepared: DataFrame, cfg: ForecastConfig | None = None, test_size: int = 12, step_size: int = 1) -> DataFrame:
    """One row of metrics per series, as for the moving average."""
    folds = backtest_folds(prepared, cfg, test_size, step_size)
    return series.backtest_metrics(folds, series.test_period(prepared, test_size))


def model_diagnostics(prepared: DataFrame, cfg: ForecastConfig | None = None) -> DataFrame:
    """One row per series: model, observations, likelihood, AIC, BIC, residuals, Ljung-Box p-value and the terms as a map.

    Series whose model can't be fitted are marked `simple` and have NULL in the other columns but the number of observations.
    """
    cfg = cfg or ForecastConfig()
    prepared = stored(series.long_enough(prepared), "prepared")
    season = cfg.seasonal_period if any(cfg.seasonal_order) else 0
    models = arima_models(prepared, cfg)
    portmanteau = series.ljung_box(arima.residual_rows(models)).select("series_id", F.col("p_value").alias("ljung_box_pvalue"))
    rows = arima.diagnostics(models, season=season).drop("observations").join(portmanteau, "series_id", "left").join(arima.coefficients(models, season=season), "series_id")
    lengths = prepared.groupBy("series_id").agg(F.max("n").cast("bigint").alias("observations"))
    return lengths.join(rows, "series_id", "left").withColumn("model", F.when(F.col("d").isNull(), "simple").otherwise("arima"))
