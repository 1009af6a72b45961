from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketflow.config import ForecastConfig, IndexConfig, QualityConfig
from basketflow.functions import numeric, text
from basketflow.functions.timeparts import calendar_columns, date_range, run_id_text
from basketflow.schema import CPI_WEIGHTS, category_map_table, hierarchy_table, weights_table


def one(spark, value, fn, kind="STRING"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "raw,price",
    [
        ("$29.99", 29.99), ("$1,234.50", 1234.5), (" 29.99 ", 29.99), ("\t5\n", 5.0), (" 7.5", 7.5), ("-10", -10.0),
        ("+3.", 3.0), (".5", 0.5), ("1e3", 1000.0), ("abc", None), ("1d", None), ("2F", None), ("0x10", None), ("", None),
        ("NaN", None), ("Infinity", None), (None, None), ("1 000", None), ("0", 0.0),
    ],
)
def test_clean_price(spark, raw, price):
    assert one(spark, raw, text.clean_price) == price


@pytest.mark.parametrize(
    "url,ok",
    [
        ("https://example.com/product/1", True), ("ftp://host", True), ("not-a-valid-url", False), ("//host/x", False),
        ("http:///path", False), ("http://", False), (None, False), ("https://höst.example/ä b", True),
    ],
)
def test_url(spark, url, ok):
    assert one(spark, url, text.is_valid_url) is ok


def test_ids_and_urls(spark):
    assert one(spark, "https://www.amazon.com/dp/B001EO5Q64?x=1", text.amazon_id) == "B001EO5Q64"
    assert one(spark, "https://www.amazon.com/dp/B001EO5Q6", text.amazon_id) is None
    assert one(spark, "https://www.walmart.com/ip/great-milk/100012345", text.walmart_id) == "100012345"
    assert one(spark, "https://www.walmart.com/ip/100012345", text.walmart_id) is None
    row = spark.sql("SELECT 'Walmart' r, '77' i, 'Great Value Milk' n")
    assert row.select(text.product_url(F.col("r"), F.col("i"), F.col("n"))).first()[0] == "https://www.walmart.com/ip/great-value-milk/77"


@pytest.mark.parametrize(
    "retailer,raw,cpi",
    [("Amazon", "Food", "grocery"), ("walmart", "PHARMACY", "medical"), ("amazon", "pharmacy", "other"), ("amazon", "zzz", "other"), ("Target", "food", "other")],
)
def test_category(spark, retailer, raw, cpi):
    row = spark.createDataFrame([(retailer, raw)], "r STRING, c STRING")
    assert row.select(text.normalize_category(F.col("r"), F.col("c"))).first()[0] == cpi


@pytest.mark.parametrize(
    "price,unit,quantity,expected",
    [(10.0, "oz", 8.0, 20.0), (10.0, "QT", 2.0, 20.0), (10.0, "lb", 4.0, 2.5), (10.0, "box", 4.0, 2.5), (10.0, None, 4.0, 10.0), (10.0, "", 4.0, 10.0), (10.0, "oz", 0.0, 10.0), (10.0, "oz", None, 10.0)],
)
def test_unit_price(spark, price, unit, quantity, expected):
    row = spark.createDataFrame([(price, unit, quantity)], "p DOUBLE, u STRING, q DOUBLE")
    assert row.select(numeric.unit_price(F.col("p"), F.col("u"), F.col("q"))).first()[0] == expected


def test_quantiles_of_distributions():
    assert numeric.normal_quantile(0.95) == pytest.approx(1.959963985)
    assert numeric.t_quantile(0.95, 7) == pytest.approx(2.364624252, abs=1e-8)
    assert numeric.t_quantile(0.99, 1) == pytest.approx(63.65674116, rel=1e-5)


def test_change_from_base(spark):
    assert one(spark, 110.0, numeric.change_from_base, "DOUBLE") == pytest.approx(10.0)
    assert one(spark, 110.0, lambda c: numeric.change_from_base(c, 0.0), "DOUBLE") == 0.0


def test_calendar(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ '2024-12-30 23:59:59' t").select(*[v.alias(k) for k, v in calendar_columns(F.col("t")).items()]).first()
    assert (row.hour, row.day_of_week, row.week_of_year) == (23, 0, 1)
    assert spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05' t").select(run_id_text(F.col("t"))).first()[0] == "20240102_030405"


@pytest.mark.parametrize(
    "freq,start,end,points",
    [
        ("D", "2024-01-30", "2024-02-02", ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]),
        ("MS", "2024-01-15", "2024-03-31", ["2024-02-01", "2024-03-01"]),
        ("MS", "2024-01-01", "2024-02-01", ["2024-01-01", "2024-02-01"]),
        ("QS", "2024-01-02", "2024-12-31", ["2024-04-01", "2024-07-01", "2024-10-01"]),
        ("W", "2024-01-01", "2024-01-15", ["2024-01-07", "2024-01-14"]),
        ("QS", "2024-11-02", "2025-01-01", ["2025-01-01"]),
        ("YS", "2024-02-01", "2026-01-01", ["2025-01-01", "2026-01-01"]),
        ("D", "2024-02-02", "2024-02-01", []),
    ],
)
def test_date_range(spark, freq, start, end, points):
    rows = date_range(spark, datetime.fromisoformat(start), datetime.fromisoformat(end), freq).collect()
    assert [r.date.strftime("%Y-%m-%d") for r in rows] == points


def test_dimensions(spark):
    weights = weights_table(spark)
    assert weights.count() == 8 and weights.agg(F.sum("weight")).first()[0] == pytest.approx(1.0)
    doubled = hierarchy_table(spark).groupBy("subcategory").count().where("count > 1").collect()
    assert [r.subcategory for r in doubled] == ["insurance"]
    assert category_map_table(spark).count() == 26
    assert set(CPI_WEIGHTS) == {r.category for r in hierarchy_table(spark).select("category").distinct().collect()}


def test_config_bounds():
    for bad in (lambda: IndexConfig(confidence_level=0.4), lambda: QualityConfig(max_null_ratio=2), lambda: ForecastConfig(model_type="x"), lambda: ForecastConfig(horizon=0)):
        with pytest.raises(ValueError):
            bad()
