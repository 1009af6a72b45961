"""Registered queries: each operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.config import EtlConfig, IndexConfig
from basketflow.functions.numeric import unit_price
from basketflow.functions.text import normalize_category, strip_ws
from basketflow.functions.timeparts import ts_like
from basketflow.operators import compare, outliers, price_index, price_jumps, quality, reports, series, transform
from basketflow.plans import etl
from basketflow.schema import SUBCATEGORIES, hierarchy_table, weights_table
from basketflow.session import materialize, work_path
from basketflow.sources import catalog, ingest, panels, storage
from basketflow.streaming import jobs

BASE = datetime(1997, 1, 1)
AS_OF = datetime(1999, 1, 15)
CUT = datetime(2000, 1, 1)
FIRST, LAST = datetime(1995, 1, 2), datetime(2001, 11, 5)
FEED_NOW = datetime(2001, 11, 5)
EVENTS_START, EVENTS_NOW = datetime(2024, 1, 1), datetime(2024, 1, 31)
INTRADAY = [datetime(1998, 6, 30, 6, 30), datetime(1999, 1, 15), datetime(1999, 1, 15, 12)]
CFG = IndexConfig(base_period=BASE)
TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "price"]
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "price"]
INDEX_COLUMNS = ["price_index", "inflation_rate", "inflation_mom", "inflation_yoy"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers a query under its name; it runs with a UTC session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


def _day(df: DataFrame, *names: str) -> DataFrame:
    """Dates as text, so that every client shows them alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in names})


def _index_rows(result: DataFrame) -> DataFrame:
    out = result.select("as_of", "observation_count", *INDEX_COLUMNS, "ci_lower", "ci_upper")
    return _rounded(out, *INDEX_COLUMNS, "ci_lower", "ci_upper")


def _price_columns(panel: DataFrame) -> DataFrame:
    return panel.select("product_id", "product_name", "price", "category", "retailer", "timestamp", "unit", "quantity")


def _conformed_feed(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.conform(panels.raw_feed(spark, sf), FEED_NOW)


def _text_panel(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the feed under index categories, prices as plain text, whether numbers or not; nothing dropped."""
    raw = panels.raw_feed(spark, sf)
    names = {"product_name": strip_ws(F.col("product_name")), "category": normalize_category(F.col("retailer"), F.col("category"))}
    return raw.withColumns(names | {"price": strip_ws(F.replace(F.replace("price", F.lit("$")), F.lit(",")))})


def _feed_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The feed panel with prices as numbers, NULL where they are none; nothing dropped."""
    panel = _text_panel(spark, sf)
    return panel.withColumn("price", quality.numeric_price(panel))


def _index_panel(spark: SparkSession, sf: str) -> DataFrame:
    panel = panels.lineitem_panel(spark, sf)
    return reports.index_panel(price_index.day_statistics(panel, price_index.base_prices(panel, CFG)), CFG)


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return series.prepare(panels.monthly_series(panels.lineitem_panel(spark, sf)))


def _daily_index(spark: SparkSession, sf: str) -> DataFrame:
    daily = reports.weighted_daily_index(_index_panel(spark, sf))
    return daily.select(F.lit("all").alias("series_id"), "date", F.col("weighted_index").alias("value"))


# --- price index


@query
def nowcast_at_date(spark, sf):
    return _index_rows(price_index.index_at(panels.lineitem_panel(spark, sf), [AS_OF], CFG))


@query
def nowcast_intraday(spark, sf):
    return _index_rows(price_index.index_at(panels.lineitem_panel(spark, sf), INTRADAY, CFG))


@query
def nowcast_many_instants(spark, sf):
    """10,000 instants, some six hours and a second apart, as a column."""
    start = F.lit(FIRST).cast("timestamp_ntz")
    times = spark.range(10_000).select((start + F.make_dt_interval(F.lit(0), F.col("id").cast("int") * 6, F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("as_of"))
    return _index_rows(price_index.index_on_times(panels.lineitem_panel(spark, sf), times, CFG))


@query
def nowcast_unweighted(spark, sf):
    cfg = IndexConfig(base_period=BASE, use_weights=False)
    return _index_rows(price_index.index_at(panels.lineitem_panel(spark, sf), [AS_OF], cfg))


@query
def nowcast_empty_window(spark, sf):
    return _index_rows(price_index.index_at(panels.lineitem_panel(spark, sf), [datetime(2010, 1, 1), AS_OF], CFG))


@query
def category_breakdown(spark, sf):
    result = price_index.index_at(panels.lineitem_panel(spark, sf), [AS_OF], CFG)
    return _rounded(price_index.category_breakdown(result, CFG), "price_index", "inflation_rate", "contribution")


@query
def base_prices(spark, sf):
    return _rounded(price_index.base_prices(panels.lineitem_panel(spark, sf), CFG), "base_price")


@query
def base_price_fallback(spark, sf):
    cfg = IndexConfig(base_period=datetime(2010, 1, 1))
    return _rounded(price_index.base_prices(panels.lineitem_panel(spark, sf), cfg), "base_price")


@query
def historical_nowcasts(spark, sf):
    return _rounded(price_index.historical_index(panels.lineitem_panel(spark, sf), FIRST, LAST, CFG, "D"), *INDEX_COLUMNS)


@query
def monthly_nowcasts(spark, sf):
    return _rounded(price_index.historical_index(panels.lineitem_panel(spark, sf), FIRST, LAST, CFG, "MS"), *INDEX_COLUMNS)


@query
def nowcast_json(spark, sf):
    path = work_path(spark, "index-json")
    storage.write_json(price_index.index_at(panels.lineitem_panel(spark, sf), [AS_OF], CFG), path)
    read = spark.read.json(path, schema="as_of TIMESTAMP_NTZ, price_index DOUBLE, category_indices MAP<STRING, DOUBLE>")
    out = read.select("as_of", "price_index", F.explode("category_indices").alias("category", "category_index"))
    return _rounded(out, "price_index", "category_index")


@query
def cpi_comparison(spark, sf):
    aligned = compare.align_with_official(panels.lineitem_panel(spark, sf), panels.official_series(spark, sf), CFG)
    return _rounded(compare.comparison_metrics(aligned), "correlation", "rmse", "mae", "bias", "tracking_error")


@query
def lead_lag_correlation(spark, sf):
    aligned = compare.align_with_official(panels.lineitem_panel(spark, sf), panels.official_series(spark, sf), CFG)
    return _rounded(compare.lead_lag_correlation(aligned), "correlation")


@query
def official_cpi_change(spark, sf):
    return _day(_rounded(compare.official_yoy(panels.official_series(spark, sf)), "cpi_value", "yoy_change"), "date")


# --- ingest and transform


@query
def valid_records(spark, sf):
    return ingest.valid_records(_conformed_feed(spark, sf)).select(
        "product_id", "product_name", "price", "original_price", "currency", "category", "retailer", "url",
        "timestamp", "unit", "quantity", "in_stock", "rating", "review_count",
    )


@query
def quarantine_reasons(spark, sf):
    return ingest.quarantine_reasons(_conformed_feed(spark, sf))


@query
def category_mapping(spark, sf):
    feed = panels.raw_feed(spark, sf)
    mapped = normalize_category(F.col("retailer"), F.col("category")).alias("cpi_category")
    return feed.select("retailer", F.col("category").alias("raw_category"), mapped).groupBy(
        "retailer", "raw_category", "cpi_category"
    ).agg(F.count(F.lit(1)).alias("records"))


@query
def unit_prices(spark, sf):
    panel = panels.lineitem_panel(spark, sf)
    price = unit_price(F.col("price"), F.col("unit"), F.col("quantity"))
    return panel.select(*LINE, "unit", "quantity", price.alias("unit_price"))


@query
def transform_panel(spark, sf):
    out = transform.transform(panels.lineitem_panel(spark, sf), TIES)
    out = out.select(
        "product_id", "retailer", "timestamp", "date", "hour", "day_of_week", "week_of_year", "product_name",
        "category", "price", "price_normalized", "price_change_pct",
    )
    return _day(_rounded(out, "price_change_pct"), "date")


@query
def hourly_keep_last(spark, sf):
    panel = panels.events_panel(spark, sf).withColumns({"date": F.to_date("timestamp"), "hour": F.hour("timestamp").cast("bigint")})
    last = transform.keep_last(panel, ["product_id", "category", "date", "hour"], ["timestamp", "event_id"])
    return last.select("product_id", "category", "hour", "timestamp", "price", "event_id")


@query
def incremental_batch(spark, sf):
    since = datetime(2024, 1, 20, 12)
    return ingest.incremental(panels.events_panel(spark, sf), since, ["purchase", "view"]).select(
        "event_id", "product_id", "category", "price", "timestamp"
    )


def _run_config(spark: SparkSession, **more) -> EtlConfig:
    root = work_path(spark, "run")
    return EtlConfig(output_path=f"{root}/processed", raw_path=f"{root}/raw", **more)


@query
def run_metrics(spark, sf):
    """The daily run over the feed and over a second one whose files can't be read."""
    lines, path = panels.raw_feed(spark, sf), work_path(spark, "unreadable")
    lines.select("product_id").write.text(path)
    feeds = {"lines": lines, "unreadable": spark.read.schema(lines.schema).parquet(path)}
    log = etl.run(spark, feeds, _run_config(spark), FEED_NOW)
    counts = ["landed", "quarantined", "transformed", "outliers", "stored"]
    return _rounded(log.select("run_id", *counts, "stored_share", F.size("problems").cast("bigint").alias("problems")), "stored_share")


@query
def quarantined_records(spark, sf):
    """What a run keeps of the records that break a rule, as read back from its quarantine."""
    cfg = _run_config(spark)
    etl.land(spark, {"lines": panels.raw_feed(spark, sf)}, cfg, cfg.raw_path, FEED_NOW)
    kept = etl.landed(spark, cfg.raw_path).where(~F.col("valid"))
    return kept.groupBy("feed", F.array_join("reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("records"), F.min("timestamp").alias("first"))


@query
def repeated_run(spark, sf):
    """Rows that two runs of one id store: those of one."""
    cfg = _run_config(spark, validate=False)
    feeds = {"lines": panels.raw_feed(spark, sf)}
    for _ in range(2):
        log = etl.run(spark, feeds, cfg, FEED_NOW)
    stored = storage.read_prices(spark, f"{cfg.output_path}/prices").agg(F.count(F.lit(1)).alias("in_table"))
    return log.select("run_id", "landed", "stored").crossJoin(F.broadcast(stored))


# --- quality


@query
def quality_report(spark, sf):
    return _rounded(quality.quality_report(_text_panel(spark, sf), FEED_NOW), "value")


@query
def quality_report_gaps(spark, sf):
    """The report of a feed that lacks a required column."""
    return _rounded(quality.quality_report(_text_panel(spark, sf).drop("timestamp"), FEED_NOW), "value")


@query
def incremental_report(spark, sf):
    """The report of the later rows, with the jumps against the earlier ones."""
    panel = _feed_panel(spark, sf)
    cut = ts_like(panel, "timestamp", CUT)
    new, old = panel.where(F.col("timestamp") >= cut), panel.where(F.col("timestamp") < cut)
    rows = quality.incremental_report(new, old, FEED_NOW)
    return rows.where(F.col("check_name").isin("empty", "null_price", "negative_price", "key_duplicates", "price_jumps")).select("check_name", "value", "triggered", "message")


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_summary(quality.quality_report(_text_panel(spark, sf), FEED_NOW))


@query
def quality_summary(spark, sf):
    return _summary(spark, sf).select(
        "is_valid",
        F.array_join("errors", "; ").alias("errors"),
        F.size("warnings").cast("bigint").alias("warnings"),
        "outlier_count",
    )


@query
def quality_policies(spark, sf):
    """What the gate does with the feed under either policy: errors recorded, or raised."""
    summary, _ = materialize(_summary(spark, sf))
    rows = []
    for policy in ("record", "raise"):
        try:
            rows.append((policy, False, "; ".join(quality.quality_gate(summary, policy).errors)))
        except quality.InvalidData as e:
            rows.append((policy, True, str(e)))
    return spark.createDataFrame(rows, "policy STRING, raised BOOLEAN, errors STRING")


@query
def invalid_categories(spark, sf):
    return quality.invalid_categories(panels.raw_feed(spark, sf), quality.QualityConfig())


@query
def outlier_flags(spark, sf):
    flagged = outliers.flag_outliers(panels.lineitem_panel(spark, sf))
    return flagged.select(*LINE, "category", "z_outlier", "iqr_outlier", "is_outlier")


@query
def clean_panel(spark, sf):
    kept = outliers.drop_outliers(outliers.flag_outliers(panels.lineitem_panel(spark, sf)))
    return kept.select(*LINE, "category", "retailer", "timestamp")


@query
def outliers_per_category(spark, sf):
    flagged = outliers.flag_outliers(panels.events_panel(spark, sf))
    return flagged.groupBy("category").agg(
        F.count_if("z_outlier").alias("z_outliers"), F.count_if("iqr_outlier").alias("iqr_outliers"), F.count_if("is_outlier").alias("outliers")
    )


@query
def price_jump_counts(spark, sf):
    panel = panels.lineitem_panel(spark, sf)
    cut = ts_like(panel, "timestamp", CUT)
    return price_jumps.price_jumps(panel.where(F.col("timestamp") >= cut), panel.where(F.col("timestamp") < cut))


@query
def price_jump_warning(spark, sf):
    return price_jumps.price_jump_warning(price_jump_counts(spark, sf))


@query
def expectation_suite(spark, sf):
    return _rounded(quality.check_expectations(_feed_panel(spark, sf)), "unexpected_percent")


@query
def suite_summary(spark, sf):
    return _rounded(quality.suite_result(quality.check_expectations(_feed_panel(spark, sf))), "success_percent")


@query
def duplicate_rows(spark, sf):
    """Whole rows of the feed, of which those rated 4 and more are delivered twice."""
    times = F.when(F.col("rating") >= 4, 2).otherwise(1)
    rows = _text_panel(spark, sf).withColumn("_time", F.explode(F.sequence(F.lit(1), times))).drop("_time")
    one = quality.exact_duplicates(rows).select(F.lit("exact").alias("kind"), F.col("n").alias("records"))
    keyed = quality.key_duplicates(rows, ["product_id", "retailer"]).select(F.lit("key").alias("kind"), F.col("n").alias("records"))
    return one.unionByName(keyed)


@query
def summary_stats(spark, sf):
    stats = quality.summary_stats(_price_columns(panels.lineitem_panel(spark, sf)))
    return _rounded(stats, "price_mean", "price_median", "price_std", "price_min", "price_max", digits=4)


# --- reports


@query
def category_distribution(spark, sf):
    return reports.category_distribution(panels.lineitem_panel(spark, sf))


@query
def product_counts(spark, sf):
    return reports.product_counts(panels.lineitem_panel(spark, sf))


@query
def distinct_retailers(spark, sf):
    return reports.distinct_values(panels.lineitem_panel(spark, sf), "retailer")


@query
def data_quality_tile(spark, sf):
    return reports.data_quality_tile(panels.lineitem_panel(spark, sf))


@query
def price_describe(spark, sf):
    return reports.describe_by_category(panels.lineitem_panel(spark, sf))


@query
def price_histogram(spark, sf):
    return _rounded(reports.price_histogram(panels.lineitem_panel(spark, sf)), "bin_start", "bin_end")


@query
def daily_mean_price(spark, sf):
    return _day(reports.daily_mean_price(panels.lineitem_panel(spark, sf)), "date")


@query
def daily_category_mean(spark, sf):
    return _day(reports.daily_category_mean(panels.lineitem_panel(spark, sf)), "date")


@query
def weighted_daily_index(spark, sf):
    return _day(_rounded(reports.weighted_daily_index(_index_panel(spark, sf)), "weighted_index"), "date")


@query
def selected_daily_index(spark, sf):
    chosen = reports.select_panel(_index_panel(spark, sf), datetime(1998, 1, 1), datetime(2000, 12, 31), ["grocery", "housing"])
    return _day(_rounded(reports.weighted_daily_index(chosen), "weighted_index"), "date")


@query
def kpi_row(spark, sf):
    row = reports.kpi_row(_index_panel(spark, sf), panels.official_series(spark, sf))
    return _day(_rounded(row, "current_index", "inflation_rate", "mom_change", "official_cpi", "tracking_error"), "date")


@query
def latest_slice(spark, sf):
    return _day(_rounded(reports.latest_slice(_index_panel(spark, sf)), "price_index"), "date")


@query
def yoy_row_lag(spark, sf):
    changed = series.row_lag_change(_daily_index(spark, sf), 365)
    return _day(_rounded(changed.select("date", "value", "change"), "value", "change"), "date")


@query
def index_heatmap(spark, sf):
    return _rounded(reports.index_heatmap(_index_panel(spark, sf)), "deviation")


@query
def index_heatmap_wide(spark, sf):
    months = [f"1999-{m:02d}" for m in range(1, 13)]
    wide = reports.index_heatmap_wide(_index_panel(spark, sf), months)
    return wide.select("category", *[F.round(F.col(f"`{m}`"), 6).alias("m" + m[-2:]) for m in months])


@query
def inflation_band(spark, sf):
    months = price_index.historical_index(panels.lineitem_panel(spark, sf), FIRST, LAST, CFG, "MS")
    return months.select("date", reports.inflation_band(F.col("inflation_yoy")).alias("band"))


@query
def alerts(spark, sf):
    months = price_index.historical_index(panels.lineitem_panel(spark, sf), FIRST, LAST, CFG, "MS")
    return reports.alerts(months.withColumnRenamed("date", "as_of"))


@query
def alerts_on_yoy(spark, sf):
    months = price_index.historical_index(panels.lineitem_panel(spark, sf), FIRST, LAST, CFG, "MS")
    return reports.alerts(months.withColumnRenamed("date", "as_of"), "inflation_yoy")


@query
def weights_sorted(spark, sf):
    counts = reports.category_distribution(panels.lineitem_panel(spark, sf))
    return weights_table(spark).join(counts, "category", "left").na.fill(0, ["records"]).orderBy("weight")


@query
def subcategory_bridge(spark, sf):
    bridge = hierarchy_table(spark)
    names = sorted({s for subs in SUBCATEGORIES.values() for s in subs})
    lines = panels.table(spark, sf, "lineitem").select(
        F.element_at(F.array(*map(F.lit, names)), (F.col("l_partkey") % len(names) + 1).cast("int")).alias("subcategory"),
        "l_extendedprice",
    )
    return lines.join(bridge, "subcategory").groupBy("category", "subcategory").agg(
        F.count(F.lit(1)).alias("records"), F.round(F.sum("l_extendedprice"), 2).alias("amount")
    )


@query
def panel_preview(spark, sf):
    panel = panels.lineitem_panel(spark, sf)
    order = ["timestamp", "product_id", "retailer", "price"]
    return panel.orderBy(*order).limit(10).select(*order, "category")


# --- catalogue


@query
def source_categories(spark, sf):
    return catalog.categories(panels.part_catalog(spark, sf))


@query
def category_scan(spark, sf):
    return catalog.category_listing(panels.part_catalog(spark, sf))


@query
def top_products(spark, sf):
    listed = catalog.source(panels.part_catalog(spark, sf), "WALMART")
    return catalog.category_listing(listed, "grocery", 10)


@query
def product_lookup(spark, sf):
    urls = panels.raw_feed(spark, sf).select("retailer", "url")
    return catalog.product_lookup(urls, panels.part_catalog(spark, sf)).select(
        "retailer", "url", "product_id", "product_name", "price", "category"
    )


# --- storage


def _stored(spark: SparkSession, sf: str) -> str:
    """Line-item panel written in two overlapping runs."""
    path = work_path(spark, "prices")
    rows = _price_columns(panels.lineitem_panel(spark, sf))
    late = rows.where(F.col("timestamp") >= ts_like(rows, "timestamp", CUT))
    storage.write_prices(rows.withColumn("run_id", F.lit("20011105_000000")), path)
    storage.write_prices(late.withColumn("run_id", F.lit("20011106_000000")), path)
    return path


@query
def stored_prices(spark, sf):
    stored = storage.read_prices(spark, _stored(spark, sf))
    return _rounded(stored.groupBy("run_id", "category").agg(F.count(F.lit(1)).alias("records"), F.sum("price").alias("total")), "total", digits=2)


@query
def latest_snapshot(spark, sf):
    return storage.latest_snapshot(spark, _stored(spark, sf)).select("product_id", "retailer", "timestamp", "category", "price")


@query
def history_scan(spark, sf):
    stored = storage.read_prices(spark, _stored(spark, sf))
    rows = storage.history_scan(stored, datetime(1999, 7, 1), datetime(2000, 6, 30), "grocery")
    return rows.select("product_id", "product_name", "retailer", "timestamp", "category", "price", "unit", "quantity")


@query
def stored_by_category(spark, sf):
    path = work_path(spark, "by-category")
    rows = _price_columns(panels.lineitem_panel(spark, sf)).withColumn("run_id", F.lit("20011105_000000"))
    storage.write_by_category(rows, path)
    stored = storage.read_prices(spark, path)
    return stored.groupBy("category", "run_id").agg(F.count(F.lit(1)).alias("records"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


@query
def raw_landing(spark, sf):
    path = work_path(spark, "raw")
    storage.write_raw(panels.raw_feed(spark, sf), path, "20011105_000000")
    return spark.read.parquet(path).groupBy("run_id", "retailer", "category").agg(
        F.count(F.lit(1)).alias("records"), F.count("price").alias("priced")
    )


@query
def retention_report(spark, sf):
    dated = panels.lineitem_panel(spark, sf).select(F.to_date("timestamp").alias("date"))
    return storage.retention_report(dated, CUT.date())


@query
def retention_files(spark, sf):
    """Runs, and whether there are files and bytes, on either side of the cutoff."""
    report = storage.retention_files(spark, _stored(spark, sf), "20011106_000000")
    return report.select("status", "runs", (F.col("files") >= F.col("runs")).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


@query
def retention_drop(spark, sf):
    """What is left when the older run has expired: its folder and marker are gone, the newest run stays."""
    path = _stored(spark, sf)
    dropped = storage.drop_expired_runs(spark, path, datetime.now() + timedelta(days=500))
    left = storage.read_prices(spark, path).groupBy("run_id").agg(F.count(F.lit(1)).alias("records"))
    return left.withColumn("runs_deleted", F.lit(dropped["runs_deleted"]).cast("bigint"))


@query
def nowcast_stored(spark, sf):
    """The index over a stored table."""
    return _index_rows(price_index.index_at(storage.load_prices(spark, _stored(spark, sf)), [AS_OF], CFG))


@query
def csv_series_scan(spark, sf):
    path = work_path(spark, "series-csv")
    panels.monthly_series(panels.lineitem_panel(spark, sf)).write.csv(path, header=True)
    return _day(_rounded(storage.read_series(spark, path), "value"), "date")


# --- series and models


@query
def seasonal_adjusted_series(spark, sf):
    return _day(_rounded(series.seasonal_adjust(_series(spark, sf)), "value", "seasonal", "adjusted"), "date")


@query
def ma_forecast(spark, sf):
    out = series.moving_average_forecast(_series(spark, sf))
    return _day(_rounded(out, "forecast", "lower", "upper"), "date")


@query
def ma_forecast_daily(spark, sf):
    out = series.moving_average_forecast(series.prepare(_daily_index(spark, sf)), 30)
    return _day(_rounded(out, "forecast", "lower", "upper"), "date")


@query
def ma_backtest_folds(spark, sf):
    folds = series.moving_average_folds(_series(spark, sf))
    return _day(_rounded(folds, "actual", "predicted", "lower", "upper"), "date").withColumn("pos", F.col("pos").cast("bigint"))


@query
def backtest_metrics(spark, sf):
    prepared = _series(spark, sf)
    rows = series.backtest_metrics(series.moving_average_folds(prepared), series.test_period(prepared))
    names = ["rmse", "mae", "mape", "directional_accuracy", "coverage_probability", "forecast_bias"]
    return _day(_rounded(rows, *names), "test_period_start", "test_period_end")


@query
def backtest_errors(spark, sf):
    arrays = series.backtest_arrays(series.moving_average_folds(_series(spark, sf)))
    rows = arrays.select("series_id", F.posexplode("errors").alias("fold", "error"))
    return _rounded(rows.withColumn("fold", F.col("fold").cast("bigint")), "error")


@query
def ljung_box(spark, sf):
    return _rounded(series.ljung_box(series.moving_average_residuals(_series(spark, sf))), "q", "p_value")


@query
def short_series(spark, sf):
    by_retailer = panels.lineitem_panel(spark, sf).groupBy(
        F.concat("product_id", F.lit("@"), "retailer").alias("series_id"), F.trunc(F.to_date("timestamp"), "month").alias("date")
    ).agg(F.avg("price").alias("value"))
    return series.too_short(series.prepare(by_retailer)).withColumn("points", F.col("points").cast("bigint"))


@query
def forecast_band_table(spark, sf):
    out = series.forecast_band_table(series.moving_average_forecast(_series(spark, sf)))
    return _rounded(out, "forecast", "lower", "upper")


@query
def first_forecast_steps(spark, sf):
    out = series.moving_average_forecast(_series(spark, sf)).where("step <= 3")
    return _day(_rounded(out.select("series_id", "step", "date", "forecast"), "forecast"), "date")


@query
def band_outline(spark, sf):
    outline = series.band_outline(series.moving_average_forecast(_series(spark, sf)))
    points = outline.select("series_id", F.posexplode(F.arrays_zip("x", "y")).alias("i", "p"))
    rows = points.select("series_id", F.col("i").cast("bigint").alias("i"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    return _day(_rounded(rows, "y"), "x")


@query
def forecast_chart_series(spark, sf):
    prepared = _series(spark, sf)
    chart = series.chart_series(prepared, series.moving_average_forecast(prepared))
    return _day(_rounded(chart, "value", "lower", "upper"), "date")


@query
def forecast_json(spark, sf):
    prepared, path = _series(spark, sf), work_path(spark, "forecast-json")
    ahead = series.moving_average_forecast(prepared)
    scores = series.backtest_metrics(series.moving_average_folds(prepared), series.test_period(prepared))
    storage.write_json(series.forecast_documents(ahead, scores), path)
    read = spark.read.json(
        path,
        schema="series_id STRING, model STRING, dates ARRAY<STRING>, values ARRAY<DOUBLE>, confidence_lower ARRAY<DOUBLE>, "
        "confidence_upper ARRAY<DOUBLE>, backtest STRUCT<rmse: DOUBLE, test_period_start: STRING>",
    )
    points = read.select(
        "series_id", "model", F.col("backtest.rmse").alias("rmse"), F.posexplode(F.arrays_zip("dates", "values", "confidence_upper")).alias("i", "p")
    )
    out = points.select(
        "series_id", "model", "rmse", F.col("i").cast("bigint").alias("i"), F.col("p.dates").alias("date"),
        F.col("p.values").alias("forecast"), F.col("p.confidence_upper").alias("upper"),
    )
    return _rounded(out, "rmse", "forecast", "upper")


# --- streams


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events dealt by id over files, one micro-batch each, so that hours and days come mixed."""
    events = panels.table(spark, sf, "events")
    path = work_path(spark, "event-files")
    events.repartition(6, "event_id").write.parquet(path)
    return panels.as_events_panel(jobs.read_stream(spark, path, "*.parquet", events.schema, 1))


@query
def stream_hourly_last(spark, sf):
    out, marks = work_path(spark, "hourly"), work_path(spark, "hourly-marks")
    last = jobs.hourly_last(["event_id"])
    schema = jobs.run_available(_event_stream(spark, sf), last, out, marks, merge=last)
    state = jobs.merged(spark, out, schema, last)
    return state.select("product_id", "retailer", F.date_format("hour_start", "yyyy-MM-dd HH").alias("hour"), "price", "category", "event_id")


@query
def stream_category_index(spark, sf):
    out, marks = work_path(spark, "daily"), work_path(spark, "daily-marks")
    base = price_index.base_prices(panels.events_panel(spark, sf), IndexConfig(base_period=EVENTS_START, base_days=10))
    schema = jobs.run_available(_event_stream(spark, sf), jobs.daily_relatives(base), out, marks, merge=jobs.daily_sums)
    state = jobs.merged(spark, out, schema, jobs.daily_sums)
    return _day(_rounded(jobs.sliding_index(state), "price_index"), "window_start", "window_end")
