from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from conftest import day
from pyspark.sql import functions as F

from basketflow.config import QualityConfig
from basketflow.operators import price_jumps, quality
from basketflow.operators.outliers import drop_outliers, flag_outliers

NOW = datetime(2024, 1, 3)


def panel(spark, prices, category="grocery"):
    return spark.createDataFrame([(category, None if p is None else float(p), i) for i, p in enumerate(prices)], "category STRING, price DOUBLE, i INT")


def flags(spark, prices, category="grocery"):
    rows = flag_outliers(panel(spark, prices, category)).orderBy("i").collect()
    return [r.z_outlier for r in rows], [r.iqr_outlier for r in rows]


def test_group_sizes(spark):
    assert flags(spark, [1, 1000]) == ([False] * 2, [False] * 2)
    assert not any(flags(spark, [1, 1, 1000])[1])
    assert flags(spark, [1, 1, 1, 1000])[1] == [False, False, False, True]


def test_z_score_and_zero_deviation(spark):
    assert flags(spark, [10] * 30 + [10000])[0] == [False] * 30 + [True]
    assert not any(flags(spark, [5] * 20)[0]) and not any(flags(spark, [5] * 20)[1])


def test_rows_with_null_price_count_for_the_guard(spark):
    z, iqr = flags(spark, [1, 1, 1000, None])
    assert z == [False] * 4
    q1, q3 = np.quantile([1, 1, 1000], [0.25, 0.75])
    assert iqr == [False, False, bool(1000 > q3 + 1.5 * (q3 - q1)), False]


def test_null_category_is_never_flagged(spark):
    assert not any(flags(spark, [1] * 30 + [1e6], None)[0])


def test_against_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"category": rng.choice(["a", "b", "c"], 3000), "price": np.round(rng.lognormal(3, 1, 3000), 2)})
    pdf["i"] = range(len(pdf))
    wanted = set()
    for _, g in pdf.groupby("category"):
        z = ((g.price - g.price.mean()) / g.price.std()).abs()
        q1, q3 = g.price.quantile(0.25), g.price.quantile(0.75)
        wanted |= set(g.i[(z > 3) | (g.price < q1 - 1.5 * (q3 - q1)) | (g.price > q3 + 1.5 * (q3 - q1))])
    flagged = flag_outliers(spark.createDataFrame(pdf))
    assert {r.i for r in flagged.where("is_outlier").collect()} == wanted
    assert drop_outliers(flagged).count() == 3000 - len(wanted)


FULL = "product_id STRING, product_name STRING, price DOUBLE, category STRING, retailer STRING, timestamp TIMESTAMP_NTZ"


def records(spark, rows):
    return spark.createDataFrame(rows, FULL)


def fired(report):
    return {(r.check_name, r.subject): r for r in report.where("triggered").collect()}


def test_clean_panel_passes(spark):
    rows = [(f"p{i}", "n", 10.0 + i, "grocery", "r", day("2024-01-02T12:00:00")) for i in range(5)]
    report = quality.quality_report(records(spark, rows), NOW)
    assert fired(report) == {}
    assert quality.quality_summary(report).first().asDict() == {"is_valid": True, "errors": [], "warnings": [], "outlier_count": 0}


def test_every_check_fires(spark):
    t = day("2024-01-01")
    rows = [("p", "n", 5.0, "grocery", "r", t), ("p", "n", 5.0, "grocery", "r", t), ("p", None, -1.0, "toys", "r", t), ("q", None, None, None, "r", t), ("q", "n", 2e5, "other", None, t)]
    hits = fired(quality.quality_report(records(spark, rows), NOW))
    assert hits["null_price", "price"].message == "Found 1 null price values"
    assert hits["below_min", "price"].value == 1 and hits["above_max", "price"].value == 1
    assert hits["negative_price", "price"].severity == "error"
    assert hits["completeness", ""].message == "Data completeness (83.33%) below threshold (95.00%)"
    assert hits["null_ratio", "product_name"].message == "Column 'product_name' has high null ratio: 40.00%"
    assert hits["stale", "timestamp"].message == "5 records are older than 1 day, 0:00:00"
    assert hits["invalid_categories", "category"].value == 1
    assert hits["exact_duplicates", ""].value == 1
    assert hits["key_duplicates", "product_id, retailer"].value == 2


def test_null_keys_count_as_equal(spark):
    df = spark.createDataFrame([(None, "r"), (None, "r"), ("a", None), ("a", None)], "product_id STRING, retailer STRING")
    assert quality.key_duplicates(df, ["product_id", "retailer"]).first().n == 2
    assert quality.exact_duplicates(df).first().n == 2


def test_duplicates_with_a_map_column(spark):
    df = spark.createDataFrame([("a", {"x": "1", "y": "2"}), ("a", {"y": "2", "x": "1"}), ("a", {})], "k STRING, m MAP<STRING, STRING>")
    assert quality.exact_duplicates(df).first().n == 1


def test_missing_columns_and_text_prices(spark):
    df = spark.createDataFrame([("x", 1)], "some_column STRING, n INT")
    report = quality.quality_report(df, NOW)
    assert {s for c, s in fired(report) if c == "required_column"} == {"product_id", "product_name", "price", "category", "retailer", "timestamp"}
    assert not quality.quality_summary(report).first().is_valid
    text = spark.createDataFrame([("1.5",), ("$2",), (None,)], "price STRING")
    hits = fired(quality.quality_report(text, NOW))
    assert hits["data_type", "price"].value == 1 and hits["null_price", "price"].value == 2


def test_empty_frame_is_one_error(spark):
    summary = quality.quality_summary(quality.quality_report(records(spark, []), NOW)).first()
    assert (summary.is_valid, summary.errors, summary.warnings) == (False, ["DataFrame is empty"], [])


def test_gate(spark):
    bad = quality.quality_summary(quality.quality_report(records(spark, [("p", "n", -1.0, "grocery", "r", day("2024-01-02T12:00:00"))]), NOW))
    assert quality.quality_gate(bad).errors == ["Found 1 negative prices"]
    with pytest.raises(quality.InvalidData):
        quality.quality_gate(bad, "raise")


def test_expectations(spark):
    rows = [("a", "n", 5.0, "grocery", "r", None), (None, "n", 2e6, "toys", "r", None), ("c", "n", None, None, "r", None)]
    got = {(r.expectation, r.column): r for r in quality.check_expectations(records(spark, rows)).collect()}
    assert got["values_to_be_between", "price"].unexpected_count == 1 and got["values_to_be_between", "price"].element_count == 2
    assert got["values_to_not_be_null", "product_id"].unexpected_count == 1
    assert got["values_to_be_in_set", "category"].unexpected_percent == 50.0
    assert got["column_to_exist", "price"].success
    missing = {(r.expectation, r.column): r.success for r in quality.check_expectations(spark.range(1)).collect()}
    assert not any(missing.values())


def test_summary_stats(spark):
    rows = [("a", "n", 1.0, "grocery", "r", None), ("b", "n", 2.0, "grocery", "s", None), ("b", "n", 9.0, None, "s", None), ("b", "n", None, None, "s", None)]
    row = quality.summary_stats(records(spark, rows)).first()
    assert (row.total_records, row.unique_products, row.unique_retailers, row.categories) == (4, 2, 2, 1)
    assert (row.price_mean, row.price_median, row.price_min, row.price_max) == (4.0, 2.0, 1.0, 9.0)
    assert row.price_std == pytest.approx(np.std([1, 2, 9], ddof=1))


def test_half_of_all_rows_the_same(spark):
    """A hot record: counted by hash first, compared in full once."""
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    assert quality.exact_duplicates(df).first().n == 999
    assert quality.QualityConfig is QualityConfig


def test_many_repeated_rows_and_hot_ones(spark, monkeypatch):
    """More repeated hashes than are broadcast, some of them hot, nulls among the values."""
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(quality, "HOT_ROWS", 50)
    k = F.col("id") % 300
    df = spark.range(2000).select(F.when(k < 100, F.lit(None)).when(k < 200, k).otherwise(F.col("id")).alias("k"), F.create_map(F.lit("x"), k % 2).alias("m"))
    rows = [(r.k, tuple(r.m.items())) for r in df.collect()]
    assert quality.exact_duplicates(df).first().n == len(rows) - len(set(rows))


def counted_reads(spark, df):
    """df, and the counter of the rows that are read of it."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), read


def test_a_report_reads_its_source_once(spark):
    df, read = counted_reads(spark, records(spark, [(f"p{i}", "n", 10.0 + i, "grocery", "r", day("2024-01-02")) for i in range(20)]))
    report = quality.quality_report(df, NOW).collect()
    assert read.value == 20 and {r.message for r in report if r.check_name == "oldest_record"} == {"2024-01-02T00:00:00"}


def test_jumps_read_either_side_once(spark):
    sides = [counted_reads(spark, records(spark, [(f"p{i}", "n", price, "grocery", "r", None) for i in range(20)])) for price in (1.0, 9.0)]
    assert sum(r.jumps for r in price_jumps.price_jumps(sides[0][0], sides[1][0]).collect()) == 20
    assert [read.value for _, read in sides] == [20, 20]
