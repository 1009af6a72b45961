"""Comparison of the index with an official series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.config import IndexConfig
from basketflow.functions.numeric import change_from_base, correlation
from basketflow.operators.price_index import index_on_dates

LAGS = range(-4, 5)


def align_with_official(panel: DataFrame, official: DataFrame, cfg: IndexConfig) -> DataFrame:
    """(date, price_index, cpi_value, observation_count): the index as of each date of the series.

    A date without recent prices has index 100 and count 0; it takes part unless filtered out.
    """
    official = official.select(F.to_date("date").alias("date"), "cpi_value")
    index = index_on_dates(panel, official.select("date"), cfg).select(
        F.to_date("as_of").alias("date"), "price_index", "observation_count"
    )
    return official.join(index, "date")


def comparison_metrics(aligned: DataFrame) -> DataFrame:
    """One row of error metrics, index minus official; zeros below two points."""
    diff = F.col("price_index") - F.col("cpi_value")
    metrics = {
        "correlation": correlation(F.col("price_index"), F.col("cpi_value")),
        "rmse": F.sqrt(F.avg(diff * diff)),
        "mae": F.avg(F.abs(diff)),
        "bias": F.avg(diff),
        "tracking_error": F.stddev_pop(diff),
    }
    one = aligned.agg(F.count(F.lit(1)).alias("points"), *[v.alias(k) for k, v in metrics.items()])
    return one.select("points", *[F.when(F.col("points") >= 2, F.col(k)).otherwise(0.0).alias(k) for k in metrics])


def lead_lag_correlation(aligned: DataFrame) -> DataFrame:
    """(lag, correlation): the index at a position against the official value `lag` positions earlier.

    The window has one row per official release, so it is bounded by the calendar.
    """
    by_date = W.partitionBy(F.lit(0)).orderBy("date")
    shifted = aligned.select(
        "price_index", *[F.lag("cpi_value", lag).over(by_date).alias(f"c{i}") for i, lag in enumerate(LAGS)]
    )
    one = shifted.agg(*[correlation(F.col("price_index"), F.col(f"c{i}")).alias(f"r{i}") for i in range(len(LAGS))])
    rows = [F.struct(F.lit(lag).cast("bigint").alias("lag"), F.col(f"r{i}").alias("correlation")) for i, lag in enumerate(LAGS)]
    return one.select(F.inline(F.array(*rows)))


def official_yoy(official: DataFrame, base: float = 100.0) -> DataFrame:
    """The official series with its percent change against the base value."""
    return official.withColumn("yoy_change", change_from_base(F.col("cpi_value"), base))
