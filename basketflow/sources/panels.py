"""Price panels bound to the test tables: part prices over years, events within days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.functions.text import product_url

# Which index category a part type stands for.
PART_TYPE_CATEGORY = {
    "ECONOMY": "grocery",
    "STANDARD": "housing",
    "SMALL": "apparel",
    "LARGE": "transportation",
    "MEDIUM": "medical",
    "PROMO": "recreation",
}
UNITS = ["oz", "lb", "gal", "qt", "ct", "box"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_category(p_type):
    expr = F.lit(None)
    for part_type, category in PART_TYPE_CATEGORY.items():
        expr = F.when(p_type == part_type, category).otherwise(expr)
    return F.coalesce(expr, F.lit("other"))


def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("product_id"),
        F.col("p_name").alias("product_name"),
        part_category(F.col("p_type")).alias("category"),
        "p_size",
    )


def lineitem_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History panel: one price observation per line item, dated by its ship date."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(part_products(spark, sf_dir), "l_partkey").select(
        "product_id",
        "product_name",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        "category",
        F.col("l_suppkey").cast("string").alias("retailer"),
        F.col("l_shipdate").alias("timestamp"),
        F.element_at(F.array(*map(F.lit, UNITS)), F.col("p_size") % 6 + 1).alias("unit"),
        F.col("l_quantity").alias("quantity"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
    )


def as_events_panel(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("product_id"),
        F.col("value").alias("price"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").alias("retailer"),
        F.col("ts").alias("timestamp"),
        "event_id",
    )


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with times within the day: one price observation per event."""
    return as_events_panel(table(spark, sf_dir, "events"))


def _coded_id(retailer, p_partkey):
    key = p_partkey.cast("string")
    return F.when(retailer == "Amazon", F.concat(F.lit("B"), F.lpad(key, 9, "0"))).otherwise(
        (p_partkey + 100000000).cast("string")
    )


# The retailers' own category names of the part types.
RAW_CATEGORY = {
    "ECONOMY": "Grocery",
    "STANDARD": "Household",
    "SMALL": "Clothing",
    "LARGE": "Automotive",
    "MEDIUM": "Pharmacy",
    "PROMO": "Beauty & Care",
}


def _raw_category(p_type):
    return F.coalesce(*[F.when(p_type == k, v) for k, v in RAW_CATEGORY.items()], F.lit("Misc"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as a source delivers them: price texts, untrimmed names, some rows broken."""
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    flag, line, tax = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_tax")
    # Small codes of what makes a row odd, so that the join moves no column that only decides.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_shipdate",
        F.coalesce(F.col("l_suppkey") % 2 == 0, F.lit(False)).alias("even"),
        F.coalesce(F.col("l_discount") == 0.1, F.lit(False)).alias("none"),
        F.when((line == 7) & (flag == "R"), 1).when((line == 6) & (flag == "N"), 2).when((line == 5) & (flag == "A"), 3).otherwise(0).cast("tinyint").alias("kind"),
        F.when(tax == 0.08, 1).when(tax == 0.07, 2).otherwise(0).cast("tinyint").alias("link"),
    )
    rows = (
        lines.join(part, "l_partkey")
        .withColumn("retailer", F.when(F.col("even"), "Amazon").otherwise("Walmart"))
        .withColumn("product_id", _coded_id(F.col("retailer"), F.col("l_partkey")))
    )
    amount, kind, link = F.format_number("l_extendedprice", 2), F.col("kind"), F.col("link")
    price = (
        F.when(kind == 1, F.lit("N/A"))
        .when(kind == 2, F.concat(F.lit("-$"), amount))
        .when(kind == 3, F.lit(None))
        .otherwise(F.concat(F.lit(" $"), amount, F.lit(" ")))
    )
    url = (
        F.when(link == 1, "not-a-valid-url")
        .when(link == 2, "//host-only/dp/B000000001")
        .otherwise(product_url(F.col("retailer"), F.col("product_id"), F.col("p_name")))
    )
    return rows.select(
        "product_id",
        F.concat(F.lit("\t "), "p_name", F.lit(" ")).alias("product_name"),
        price.alias("price"),
        F.col("p_retailprice").alias("original_price"),
        _raw_category(F.col("p_type")).alias("category"),
        "retailer",
        url.alias("url"),
        F.col("l_shipdate").alias("timestamp"),
        F.element_at(F.array(*map(F.lit, UNITS)), F.col("p_size") % 6 + 1).alias("unit"),
        F.when(F.col("none"), 0.0).otherwise(F.col("l_quantity")).alias("quantity"),
        F.round(F.col("l_quantity") / 9, 1).alias("rating"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("review_count"),
        F.create_map(F.lit("order"), F.col("l_orderkey").cast("string")).alias("metadata"),
    )


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of both retailers: every part, listed by its key."""
    part = table(spark, sf_dir, "part")
    retailer = F.explode(F.array(F.lit("Amazon"), F.lit("Walmart")))
    return part.withColumn("retailer", retailer).select(
        "retailer",
        _raw_category(F.col("p_type")).alias("category"),
        _coded_id(F.col("retailer"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("price"),
        F.col("p_partkey").alias("listing_pos"),
    )


def official_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the official series: monthly mean order value, first month = 100."""
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("date"))
        .agg(F.avg("o_totalprice").alias("v"))
    )
    first = F.first("v").over(W.partitionBy(F.lit(0)).orderBy("date"))  # one row per month
    return monthly.select("date", (F.col("v") / first * 100).alias("cpi_value"))


def monthly_series(panel: DataFrame, by: str = "category") -> DataFrame:
    """Mean price per category (or product) and month: many series for the forecasts."""
    return panel.groupBy(F.col(by).alias("series_id"), F.trunc(F.to_date("timestamp"), "month").alias("date")).agg(
        F.avg("price").alias("value")
    )
