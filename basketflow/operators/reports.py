"""Aggregates behind the dashboard and the notebook, and the alert rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.config import IndexConfig
from basketflow.functions.numeric import nan_to_null, pct_change
from basketflow.functions.timeparts import month_label
from basketflow.operators.quantiles import exact_quantiles
from basketflow.schema import weights_table
from basketflow.session import join_checked

# Alert thresholds (strict) and gauge bands, in percent.
HIGH_INFLATION = 5.0
DEFLATION = 0.0
GREEN_BELOW = 2.0
YELLOW_BELOW = 4.0


def alerts(index: DataFrame, column: str = "inflation_rate") -> DataFrame:
    """One row per fired alert: as_of, type, message, severity.

    The rate is taken to nine digits, so that the noise of a sum around 100 raises no alert.
    """
    rate = F.round(column, 9)

    def alert(kind: str, text: str, fired: Column) -> Column:
        row = F.struct(
            F.lit(kind).alias("type"),
            F.concat(F.lit(text), F.format_string("%.2f%%", rate)).alias("message"),
            F.lit("warning").alias("severity"),
        )
        return F.when(fired, row)

    fired = F.array(
        alert("high_inflation", "High inflation detected: ", rate > HIGH_INFLATION),
        alert("deflation", "Deflation detected: ", rate < DEFLATION),
    )
    return index.select("as_of", F.inline(F.array_compact(fired)))


def inflation_band(rate: Column) -> Column:
    return F.when(rate < GREEN_BELOW, "green").when(rate < YELLOW_BELOW, "yellow").otherwise("red")


def latest_slice(df: DataFrame) -> DataFrame:
    """Rows of the newest date. The newest date is read first, so that the scan can skip the rest."""
    newest = df.agg(F.max("date")).first()[0]
    return df.where(F.col("date") == F.lit(newest))


def _mean_price() -> Column:
    """Mean over prices as decimals of eight digits: exact sums, so the order of rows leaves no trace."""
    price = nan_to_null(F.col("price")).cast("decimal(20,8)")
    return (F.sum(price).cast("double") / F.count(price)).alias("avg_price")


def daily_mean_price(panel: DataFrame) -> DataFrame:
    return panel.groupBy(F.to_date("timestamp").alias("date")).agg(_mean_price())


def daily_category_mean(panel: DataFrame) -> DataFrame:
    return panel.groupBy(F.to_date("timestamp").alias("date"), "category").agg(_mean_price())


def category_distribution(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("category").isNotNull()).groupBy("category").agg(F.count(F.lit(1)).alias("records"))


def product_counts(panel: DataFrame) -> DataFrame:
    """Observations per retailer and per category in one pass."""
    return (
        panel.groupingSets([["retailer"], ["category"]], "retailer", "category")
        .agg(F.grouping("retailer").alias("by_category"), F.count("product_id").alias("records"))
        .select(
            F.when(F.col("by_category") == 1, "category").otherwise("retailer").alias("dimension"),
            F.when(F.col("by_category") == 1, F.col("category")).otherwise(F.col("retailer")).alias("name"),
            "records",
        )
        .where(F.col("name").isNotNull())
    )


def distinct_values(panel: DataFrame, column: str) -> DataFrame:
    return panel.select(column).distinct()


def describe_by_category(panel: DataFrame) -> DataFrame:
    """count, mean, std, min, quartiles and max per category, rounded to 2."""
    moments = {"count": F.count("v"), "mean": F.avg("v"), "std": F.stddev_samp("v"), "min": F.min("v"), "max": F.max("v")}
    q = exact_quantiles(panel.withColumn("price", nan_to_null(F.col("price"))), ["category"], "price", [0.25, 0.5, 0.75], moments)
    out = q.select("category", *moments, *[F.col("q")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))])
    return out.select("category", "count", *[F.round(c, 2).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def price_histogram(panel: DataFrame, bins: int = 8) -> DataFrame:
    """Equal-width bins per category between its lowest and highest price; the last bin is closed.

    A category with one price only gets the range of half a unit to both sides.
    """
    rows = panel.withColumn("price", nan_to_null(F.col("price"))).where(F.col("category").isNotNull() & F.col("price").isNotNull()).select("category", "price")
    ends = rows.groupBy("category").agg(F.min("price").alias("lo"), F.max("price").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        "category",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    place = F.floor((F.col("price") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counted = (
        join_checked(rows, ends, ["category"], "inner")
        .groupBy("category", "lo", "hi", F.least(place, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select(
        "category",
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_start"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_end"),
        "records",
    )


def index_panel(stats: DataFrame, cfg: IndexConfig) -> DataFrame:
    """(date, category, price_index, weight) from the daily statistics of the index."""
    daily = stats.groupBy(F.col("day").alias("date"), "category").agg(F.sum("n_rel").alias("n"), F.sum("ln_sum").alias("s"))
    daily = daily.where("n > 0").select("date", "category", (F.exp(F.col("s") / F.col("n")) * 100).alias("price_index"))
    return daily.join(weights_table(stats.sparkSession, cfg.weights), "category")


def select_panel(panel: DataFrame, start: datetime, end: datetime, categories: list[str]) -> DataFrame:
    """Dashboard filter: dates from start to end, both included, and chosen categories."""
    return panel.where(
        F.col("date").between(F.lit(start.date()), F.lit(end.date())) & F.col("category").isin(categories)
    )


def weighted_daily_index(panel: DataFrame) -> DataFrame:
    """Sum of index times weight per date, not divided by the weights."""
    return panel.groupBy("date").agg(F.sum(F.col("price_index") * F.col("weight")).alias("weighted_index"))


def kpi_row(panel: DataFrame, official: DataFrame) -> DataFrame:
    """One row: index normalised by the weights on the newest date, its rate, the change to the
    date exactly 30 days before (0 when absent), the newest official value and the gap to it."""
    by_date = panel.groupBy("date").agg(
        (F.sum(F.col("price_index") * F.col("weight")) / F.sum("weight")).alias("idx")
    )
    newest = by_date.agg(F.max_by("idx", "date").alias("current_index"), F.max("date").alias("date"))
    before = by_date.select(F.date_add("date", 30).alias("date"), F.col("idx").alias("month_ago"))
    last = official.agg(F.coalesce(F.max_by("cpi_value", "date"), F.lit(100.0)).alias("v")).scalar()
    return (
        newest.join(before, "date", "left")
        .withColumn("official_cpi", last)
        .select(
            "date",
            "current_index",
            (F.col("current_index") - 100).alias("inflation_rate"),
            F.coalesce(pct_change(F.col("current_index"), F.col("month_ago")), F.lit(0.0)).alias("mom_change"),
            "official_cpi",
            F.abs(F.col("current_index") - F.col("official_cpi")).alias("tracking_error"),
        )
    )


def index_heatmap(panel: DataFrame) -> DataFrame:
    """(category, month, deviation): mean index of the month minus 100."""
    return panel.groupBy("category", month_label(F.col("date")).alias("month")).agg(
        (F.avg("price_index") - 100).alias("deviation")
    )


def index_heatmap_wide(panel: DataFrame, months: list[str]) -> DataFrame:
    """The same with one column per named month."""
    return (
        panel.withColumn("month", month_label(F.col("date")))
        .where(F.col("month").isin(months))
        .groupBy("category")
        .pivot("month", months)
        .agg(F.avg("price_index") - 100)
    )


def data_quality_tile(panel: DataFrame) -> DataFrame:
    return panel.agg(
        F.count(F.lit(1)).alias("total_observations"), F.countDistinct("category").alias("categories_tracked")
    )
