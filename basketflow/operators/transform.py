"""Cleaning of a price panel: calendar columns, text, keep-last, unit price, price change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.functions.numeric import unit_price
from basketflow.functions.text import strip_ws
from basketflow.functions.timeparts import calendar_columns
from basketflow.session import BROADCAST_ROWS, materialize
from basketflow.sources.storage import comparable

PRODUCT = ["product_id", "retailer"]
HOUR_KEY = [*PRODUCT, "date", "hour"]
# A product of a retailer that more rows have is hot.
HOT_ROWS = 10_000


def parse_timestamp(df: DataFrame) -> DataFrame:
    """Text timestamps become timestamps; unreadable ones become NULL."""
    if df.schema["timestamp"].dataType.simpleString() != "string":
        return df
    return df.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key in the given order.

    Spark cuts every key to one row before the shuffle, so that a hot key costs one row per task.
    """
    latest = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").drop("_rn")


def add_price_change(df: DataFrame) -> DataFrame:
    """Percent change against the product's previous observation at the retailer; 0 for the first.

    Runs on a panel with one row per product, retailer and hour, so a group is bounded by the
    hours of the calendar, not by the size of the feed.
    """
    earlier = W.partitionBy(*PRODUCT).orderBy("date", "hour")
    before = F.lag("price").over(earlier)
    return df.withColumn("price_change_pct", F.coalesce((F.try_divide("price", before) - 1) * 100, F.lit(0.0)))


def hot_products(df: DataFrame, rows: int) -> DataFrame | None:
    """Hashes (_p) of the products of a retailer that very many of df's rows have, at most BROADCAST_ROWS of them; None where there are none."""
    counted = df.groupBy(F.xxhash64(*PRODUCT).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    kept, n = materialize(counted.where(F.col("_c") > max(HOT_ROWS, rows // BROADCAST_ROWS)).select("_p"))
    if n:
        return kept
    kept.unpersist()
    return None


def transform(df: DataFrame, tie_breakers: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """Enrich, clean and deduplicate. Rows are sorted at the sink only, within its files.

    Rows of one timestamp are ordered by the tie-breakers, then by all columns (maps as sorted JSON), so that chance decides nothing.

    With the number of `rows`, for a df that is cheap to read again, whole rows move once, by product and retailer, for keep-last and the price
    change alike; only rows of hot products are cut to one per key before that. Without it, all rows are cut before they move, and move twice.
    """
    df = parse_timestamp(df)
    normalized = F.col("price")
    if {"unit", "quantity"} <= set(df.columns):
        normalized = unit_price(F.col("price"), F.col("unit"), F.col("quantity"))
    first = ["timestamp", *(tie_breakers or ["price", "product_name", "category"])]
    derived = calendar_columns(F.col("timestamp")) | {"price_normalized": normalized}
    early = {k: derived.pop(k) for k in [*derived] if k in ("date", "hour", *first)}
    whole = df.withColumns({"product_name": strip_ws(F.col("product_name")), "category": strip_ws(F.lower("category"))})
    df = whole.withColumns(early)
    rest = [c for c in df.columns if c not in first and c not in derived]
    maps = {f"_{f.name}": c for f, c in zip(df.schema, comparable(df)) if isinstance(f.dataType, T.MapType)}
    order = first + [f"_{c}" if f"_{c}" in maps else c for c in rest]

    def last(some: DataFrame) -> DataFrame:
        return keep_last(some.withColumns(early).withColumns(maps), HOUR_KEY, order).drop(*maps)

    if rows is not None:
        hot = hot_products(whole, rows)
        if hot is not None:
            keyed = whole.withColumn("_p", F.xxhash64(*PRODUCT))
            cut = last(keyed.join(F.broadcast(hot), "_p", "left_semi").select(*whole.columns)).select(*whole.columns)
            whole = keyed.join(F.broadcast(hot), "_p", "left_anti").select(*whole.columns).unionByName(cut)
        whole = whole.repartition(*PRODUCT)
    out = add_price_change(last(whole))
    # What follows from the row alone is added behind the shuffles.
    names = dict.fromkeys([*df.columns, *derived, "price_change_pct"])
    return out.withColumns(derived).select(*names)
