"""Registered queries of the fitted models: tests, orders, terms, forecasts, backtests and diagnostics of every series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import ForecastConfig
from basketflow.operators import arima, forecast, series, smoothing
from basketflow.plans.queries import _daily_index, _day, _rounded, _series, query
from basketflow.session import stored

PLAIN = ForecastConfig(seasonal_order=(0, 0, 0))
SEASONAL = ForecastConfig()
FIXED = (0.3, 0.1, 0.2)
METRICS = ["rmse", "mae", "mape", "directional_accuracy", "coverage_probability", "forecast_bias"]


def _adf(prepared: DataFrame) -> DataFrame:
    rows = arima.adf(prepared).select("series_id", F.col("lags").cast("bigint").alias("lags"), "tau", "stationary", F.col("d").cast("bigint").alias("d"))
    return _rounded(rows, "tau")


def _band(rows: DataFrame) -> DataFrame:
    return _day(_rounded(rows, "forecast", "lower", "upper"), "date")


def _folds(rows: DataFrame) -> DataFrame:
    return _day(_rounded(rows, "actual", "predicted", "lower", "upper"), "date").withColumn("pos", F.col("pos").cast("bigint"))


def _metrics(rows: DataFrame) -> DataFrame:
    return _day(_rounded(rows, *METRICS), "test_period_start", "test_period_end")


@query
def adf_monthly(spark, sf):
    return _adf(stored(_series(spark, sf), "prepared"))


@query
def adf_daily(spark, sf):
    return _adf(stored(series.prepare(_daily_index(spark, sf)), "prepared"))


@query
def ets_fixed_forecast(spark, sf):
    """Exponential smoothing at fixed weights."""
    prepared = stored(_series(spark, sf), "prepared")
    return _band(forecast.ets_forecast(prepared, SEASONAL, smoothing.fixed(prepared, *FIXED)))


@query
def ets_daily_forecast(spark, sf):
    """A series of many chunks, a season of a week."""
    prepared = stored(series.prepare(_daily_index(spark, sf)), "prepared")
    cfg = ForecastConfig(model_type="ets", horizon=14, seasonal_period=7)
    return _band(forecast.ets_forecast(prepared, cfg, smoothing.fixed(prepared, *FIXED, period=7)))


@query
def ets_weights(spark, sf):
    """The weights of least squared error: on the grid, then around the best."""
    return _rounded(smoothing.fitted(stored(_series(spark, sf), "prepared")).select("series_id", *smoothing.WEIGHTS, "sse"), "sse")


@query
def ets_forecast(spark, sf):
    return _band(forecast.forecast(_series(spark, sf), ForecastConfig(model_type="ets")))


@query
def ets_backtest(spark, sf):
    return _metrics(forecast.backtest(_series(spark, sf), ForecastConfig(model_type="ets")))


@query
def arima_orders(spark, sf):
    """AIC of all nine orders of every series, and the chosen one."""
    prepared = stored(_series(spark, sf), "prepared")
    tried = stored(arima.orders(arima.listed(prepared).join(arima.adf(prepared).select("series_id", "d"), "series_id")), "orders")
    best = arima.chosen(tried).select("series_id", "p", "q", F.lit(True).alias("chosen"))
    rows = tried.select("series_id", "p", "q", "aic", "fits").join(best, ["series_id", "p", "q"], "left").na.fill(False, ["chosen"])
    return _rounded(rows.withColumns({c: F.col(c).cast("bigint") for c in "pq"}), "aic")


def _terms(spark, sf, cfg: ForecastConfig) -> DataFrame:
    models = forecast.arima_models(stored(_series(spark, sf), "prepared"), cfg)
    rows = arima.coefficients(models, season=cfg.seasonal_period if any(cfg.seasonal_order) else 0)
    rows = rows.select("series_id", *[F.col(c).cast("bigint").alias(c) for c in "dpq"], F.explode("terms").alias("term", "value"))
    return _rounded(rows, "value")


@query
def arima_terms(spark, sf):
    return _terms(spark, sf, PLAIN)


@query
def sarima_terms(spark, sf):
    return _terms(spark, sf, SEASONAL)


@query
def arima_forecast(spark, sf):
    return _band(forecast.forecast(_series(spark, sf), PLAIN))


@query
def sarima_forecast(spark, sf):
    return _band(forecast.forecast(_series(spark, sf), SEASONAL))


@query
def ensemble_forecast(spark, sf):
    return _band(forecast.forecast(_series(spark, sf), ForecastConfig(model_type="ensemble")))


@query
def arima_backtest_folds(spark, sf):
    return _folds(forecast.backtest_folds(_series(spark, sf), PLAIN))


@query
def arima_backtest(spark, sf):
    return _metrics(forecast.backtest(_series(spark, sf), PLAIN))


@query
def model_diagnostics(spark, sf):
    rows = forecast.model_diagnostics(_series(spark, sf), PLAIN)
    numbers = ["log_likelihood", "aic", "bic", "residual_mean", "residual_std", "ljung_box_pvalue"]
    return _rounded(rows.select("series_id", "model", "observations", F.size("terms").cast("bigint").alias("terms"), *numbers), *numbers)
