from datetime import datetime

import pytest
from conftest import day
from pyspark.sql import functions as F

from basketflow.sources import catalog, ingest

NOW = datetime(2024, 1, 1, 12)
GOOD = {
    "product_id": "p", "product_name": "Milk", "price": "$1,299.50", "category": "grocery", "retailer": "Amazon",
    "url": "https://example.com/p", "rating": 4.5, "quantity": 2.0,
}
COLUMNS = "product_id STRING, product_name STRING, price STRING, category STRING, retailer STRING, url STRING, rating DOUBLE, quantity DOUBLE"


def feed(spark, *changes):
    rows = [{**GOOD, **c} for c in changes]
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in COLUMNS.split(", ")) for r in rows], COLUMNS)


def test_valid_record_defaults(spark):
    row = ingest.valid_records(ingest.conform(feed(spark, {}), NOW)).first()
    assert (row.price, row.currency, row.in_stock, row.timestamp) == (1299.5, "USD", True, NOW)


@pytest.mark.parametrize(
    "change,reason",
    [
        ({"price": "-10.0"}, "price"), ({"price": "0"}, "price"), ({"price": "abc"}, "price"), ({"price": None}, "price"),
        ({"price": "NaN"}, "price"), ({"url": "not-a-valid-url"}, "url"), ({"url": None}, "url"), ({"product_id": ""}, "product_id"),
        ({"product_name": None}, "product_name"), ({"rating": 5.1}, "rating"), ({"rating": -0.1}, "rating"),
        ({"rating": float("nan")}, "rating"), ({"quantity": 0.0}, "quantity"), ({"category": ""}, "category"),
    ],
)
def test_rules(spark, change, reason):
    typed = ingest.conform(feed(spark, change), NOW)
    assert ingest.valid_records(typed).count() == 0
    assert ingest.quarantine(typed).first().reasons == [reason]


def test_edges_are_valid(spark):
    typed = ingest.conform(feed(spark, {"rating": 0.0}, {"rating": 5.0}, {"rating": None}, {"quantity": None}), NOW)
    assert ingest.valid_records(typed).count() == 4 and ingest.quarantine(typed).count() == 0


def test_valid_and_quarantine_split_everything(spark):
    typed = ingest.conform(feed(spark, {}, {"price": "x"}, {"price": "x", "url": ""}), NOW)
    assert ingest.valid_records(typed).count() + ingest.quarantine(typed).count() == 3
    assert {r.reason: r.records for r in ingest.quarantine_reasons(typed).collect()} == {"price": 2, "url": 1}


def test_unreadable_timestamp_is_broken_and_missing_one_is_now(spark):
    raw = feed(spark, {}, {}).withColumn("timestamp", F.lit("yesterday"))
    assert ingest.quarantine(ingest.conform(raw, NOW)).first().reasons == ["timestamp"]
    late = feed(spark, {}).withColumn("timestamp", F.lit("2024-01-01T05:00:00"))
    assert ingest.valid_records(ingest.conform(late, NOW)).first().timestamp == datetime(2024, 1, 1, 5)


def test_union_and_selection(spark):
    a = spark.createDataFrame([("1", "Amazon", "Grocery")], "product_id STRING, retailer STRING, category STRING")
    b = spark.createDataFrame([("2", "Walmart", "toys", 3.0)], "product_id STRING, retailer STRING, category STRING, price DOUBLE")
    both = ingest.union_feeds([a, b])
    assert both.count() == 2 and both.where("price IS NULL").count() == 1
    assert ingest.select_sources(both, ["AMAZON"], ["grocery"]).count() == 1


def test_incremental_is_strict(observations):
    rows = observations([("a", "grocery", "r", 1.0, day(f"2024-01-0{d}")) for d in (1, 2, 3)])
    assert ingest.incremental(rows, day("2024-01-02")).count() == 1
    assert ingest.incremental(rows, None, ["housing"]).count() == 0


@pytest.fixture
def shelf(spark):
    rows = [
        ("Amazon", "Grocery", "B000000001", "Whole Milk", 6.994, 1), ("Amazon", "Grocery", "B000000002", "Eggs", 5.0, 2),
        ("Amazon", "Grocery", "B000000003", "Bread", 3.0, 3), ("Walmart", "personal_care", "500", "Tooth Paste", 3.97, 1),
    ]
    return spark.createDataFrame(rows, "retailer STRING, category STRING, product_id STRING, product_name STRING, price DOUBLE, listing_pos INT")


def test_listing(shelf):
    top = catalog.category_listing(shelf, "GROCERY", 2).orderBy("listing_pos").collect()
    assert [(r.product_id, r.price, r.category) for r in top] == [("B000000001", 6.99, "grocery"), ("B000000002", 5.0, "grocery")]
    assert catalog.category_listing(shelf).where("retailer = 'Walmart'").first().url == "https://www.walmart.com/ip/tooth-paste/500"


def test_lookup(spark, shelf):
    urls = spark.createDataFrame(
        [("Amazon", "https://www.amazon.com/dp/B000000002"), ("Amazon", "https://www.amazon.com/dp/B999999999"), ("Walmart", "https://www.walmart.com/ip/x/500"), ("Walmart", "junk")],
        "retailer STRING, url STRING",
    )
    found = {r.url: r for r in catalog.product_lookup(urls, shelf).collect()}
    assert len(found) == 4
    assert found["https://www.amazon.com/dp/B000000002"].product_name == "Eggs"
    assert found["https://www.walmart.com/ip/x/500"].category == "other"
    assert found["https://www.amazon.com/dp/B999999999"].product_id is None and found["junk"].price is None


def test_source_by_name(shelf):
    assert catalog.source(shelf, "amazon").count() == 3
    assert catalog.categories(shelf).count() == 2
    with pytest.raises(ValueError):
        catalog.source(shelf, "target")
