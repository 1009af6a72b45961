"""Outlier flags per category: z-score and interquartile range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.config import QualityConfig
from basketflow.functions.numeric import nan_to_null
from basketflow.operators.quantiles import exact_quantiles
from basketflow.session import join_checked


def category_stats(df: DataFrame) -> DataFrame:
    """Per category: all rows, mean, sample deviation and exact quartiles of the price."""
    prices = df.select("category", nan_to_null(F.col("price")).alias("price"))
    moments = {"n_rows": F.count(F.lit(1)), "mean": F.avg("v"), "sd": F.stddev_samp("v")}
    return exact_quantiles(prices, ["category"], "price", [0.25, 0.75], moments).select(
        "category", *moments, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")
    )


def flag_outliers(df: DataFrame, cfg: QualityConfig | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Adds z_outlier, iqr_outlier and is_outlier. Rows without a category are never flagged.

    `stats` are the category_stats of the rows where the caller has them already.
    """
    cfg = cfg or QualityConfig()
    price = nan_to_null(F.col("price"))
    far = F.abs(F.try_divide(price - F.col("mean"), F.col("sd"))) > cfg.outlier_std_threshold
    iqr = F.col("q3") - F.col("q1")
    outside = (price < F.col("q1") - cfg.iqr_multiplier * iqr) | (price > F.col("q3") + cfg.iqr_multiplier * iqr)
    flagged = join_checked(df, category_stats(df) if stats is None else stats, ["category"]).withColumns(
        {
            "z_outlier": F.coalesce((F.col("n_rows") >= 3) & (F.col("sd") > 0) & far, F.lit(False)),
            "iqr_outlier": F.coalesce((F.col("n_rows") >= 4) & outside, F.lit(False)),
        }
    )
    return flagged.withColumn("is_outlier", F.col("z_outlier") | F.col("iqr_outlier")).drop(
        "n_rows", "mean", "sd", "q1", "q3"
    )


def drop_outliers(flagged: DataFrame) -> DataFrame:
    return flagged.where(~F.col("is_outlier")).drop("z_outlier", "iqr_outlier", "is_outlier")
