import sys

from conftest import day
from pyspark.sql import functions as F

from basketflow.operators.transform import hot_products, transform


def test_keep_last_per_hour_and_clean_text(spark):
    rows = [
        ("p", "\t Milk ", " Grocery\t", "r", 10.0, day("2024-01-01T08:05:00")), ("p", "Milk", "grocery", "r", 12.0, day("2024-01-01T08:50:00")),
        ("p", "Milk", "grocery", "r", 15.0, day("2024-01-01T09:00:00")), ("p", "Milk", "grocery", "s", 20.0, day("2024-01-01T08:00:00")),
        ("p", "Milk", "grocery", "s", 21.0, day("2024-01-01T08:00:00")),
    ]
    raw = spark.createDataFrame(rows, "product_id STRING, product_name STRING, category STRING, retailer STRING, price DOUBLE, timestamp TIMESTAMP_NTZ")
    out = transform(raw).orderBy("retailer", "timestamp").collect()
    assert [r.price for r in out] == [12.0, 15.0, 21.0]
    assert [r.price_change_pct for r in out] == [0.0, 25.0, 0.0]
    assert {(r.product_name, r.category) for r in out} == {("Milk", "grocery")}
    assert {r.price_normalized for r in out} == {12.0, 15.0, 21.0}


def test_text_timestamps_and_units(spark):
    raw = spark.createDataFrame(
        [("p", "n", "c", "r", 10.0, "2024-01-01 08:00:00", "oz", 8.0)],
        "product_id STRING, product_name STRING, category STRING, retailer STRING, price DOUBLE, timestamp STRING, unit STRING, quantity DOUBLE",
    )
    row = transform(raw).first()
    assert (row.hour, row.price_normalized) == (8, 20.0)


def test_empty_stays_empty(observations):
    empty = observations([]).withColumn("product_name", F.lit("x"))
    assert transform(empty).count() == 0


def test_hot_keys_are_cut_before_the_shuffle(observations):
    plan = transform(observations([]).withColumn("product_name", F.lit("x")))._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_columns_behind_the_tie_breakers_decide_ties(spark):
    rows = [("p", "x", "grocery", "r", 8.0, day("2024-01-01"), "lb", q) for q in (1.0, 2.0)]
    schema = "product_id STRING, product_name STRING, category STRING, retailer STRING, price DOUBLE, timestamp TIMESTAMP_NTZ, unit STRING, quantity DOUBLE"
    found = {tuple(transform(spark.createDataFrame(r, schema).coalesce(1)).first()[c] for c in ("quantity", "price_normalized")) for r in (rows, rows[::-1])}
    assert len(found) == 1


def test_columns_that_follow_from_the_row_are_not_shuffled(observations):
    plan = transform(observations([]).withColumn("product_name", F.lit("x")))._jdf.queryExecution().sparkPlan().toString()
    assert plan.rindex("weekofyear") < plan.index("Window")


HOURLY = "product_id STRING, product_name STRING, category STRING, retailer STRING, price DOUBLE, timestamp TIMESTAMP_NTZ, metadata MAP<STRING, STRING>"


def test_whole_rows_move_once_where_they_are_counted(spark):
    df = spark.createDataFrame([("p", "x", "c", "r", 1.0, day("2024-01-01"), {"a": "b"})], HOURLY)
    shuffles = [transform(df, rows=n)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for n in (None, 1)]
    assert shuffles == [2, 1]


def test_hot_products_are_cut_before_the_one_shuffle(spark, monkeypatch):
    monkeypatch.setattr(sys.modules[transform.__module__], "HOT_ROWS", 20)
    rows = [("hot", f"n{i % 3}", "c", "r", float(i % 7), day(f"2024-01-0{1 + i % 3}T0{i % 2}:00:00"), {"a": str(i), "b": "x"}) for i in range(60)]
    rows += [(None, "x", "c", None, float(i), day(f"2024-01-0{1 + i % 9}"), None) for i in range(30)]
    rows += [(f"p{i % 9}", "x", "c", "r", float(i), day(f"2024-02-0{1 + i % 9}T0{i % 4}:00:00"), {"a": str(i)}) for i in range(40)]
    df = spark.createDataFrame(rows, HOURLY).repartition(3)
    assert hot_products(df, len(rows)).count() == 2 and hot_products(df.where("product_name = 'x'").limit(20), 20) is None
    once = transform(df, rows=len(rows))
    assert once._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 3
    plain = transform(df)
    assert once.columns == plain.columns and as_text(once) == as_text(plain)


def as_text(df):
    return sorted(str(r) for r in df.collect())
