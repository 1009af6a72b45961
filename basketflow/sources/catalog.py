"""Catalogue reads: categories of a source, listings of a category, lookup by URL.

A catalogue has retailer, category (the retailer's own name), product_id, product_name,
price and listing_pos.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.functions.text import normalize_category, product_id_from_url, product_url
from basketflow.schema import CATEGORY_MAP
from basketflow.session import join_checked


def source(catalog: DataFrame, retailer: str) -> DataFrame:
    """One retailer's part of the catalogue; an unknown retailer is an error."""
    if retailer.lower() not in CATEGORY_MAP:
        raise ValueError(f"unsupported retailer: {retailer}; available: {', '.join(CATEGORY_MAP)}")
    return catalog.where(F.lower("retailer") == retailer.lower())


def categories(catalog: DataFrame) -> DataFrame:
    return catalog.select("retailer", "category").distinct()


def _as_observation(df: DataFrame, *extra: str) -> DataFrame:
    retailer = F.col("retailer")
    return df.select(
        "product_id",
        "product_name",
        F.round("price", 2).alias("price"),
        normalize_category(retailer, F.col("category")).alias("category"),
        "retailer",
        *extra,
    )


def category_listing(catalog: DataFrame, category: str | None = None, max_products: int | None = None) -> DataFrame:
    """All products per retailer and category as observations with URL, or the first ones in listing order.

    A cut, where one is named, happens before the shuffle as well, so that a large category sends few rows.
    """
    if category is not None:
        catalog = catalog.where(F.lower("category") == category.lower())
    first = catalog
    if max_products is not None:
        by_listing = W.partitionBy("retailer", F.lower("category")).orderBy("listing_pos", "product_id")
        first = catalog.withColumn("_rn", F.row_number().over(by_listing)).where(F.col("_rn") <= max_products).drop("_rn")
    url = product_url(F.col("retailer"), F.col("product_id"), F.col("product_name"))
    return _as_observation(first.withColumn("url", url), "url", "listing_pos")


def product_lookup(urls: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each (retailer, url) with its catalogue entry; NULLs where the id is unknown or absent."""
    by_listing = W.partitionBy("retailer", "product_id").orderBy("listing_pos")
    entries = (
        catalog.withColumn("_rn", F.row_number().over(by_listing))
        .where("_rn = 1")
        .select("retailer", "product_id", "product_name", "price", "category")
    )
    with_id = urls.withColumn("product_id", product_id_from_url(F.col("retailer"), F.col("url")))
    known = join_checked(with_id.where(F.col("product_id").isNotNull()), entries, ["retailer", "product_id"])
    found = F.col("price").isNotNull()
    matched = _as_observation(known, "url").withColumns(
        {c: F.when(found, F.col(c)) for c in ("product_id", "category")}
    )
    # URLs without an id stay out of the join: they would all meet in one partition.
    absent = with_id.where(F.col("product_id").isNull())
    return matched.unionByName(absent, allowMissingColumns=True)
