"""From raw records to validated observations, and the incremental read."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.functions.numeric import nan_to_null
from basketflow.functions.text import clean_price, is_valid_url
from basketflow.functions.timeparts import ts_like
from basketflow.schema import PRICE_SCHEMA


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """All feeds in one frame; a column missing in a feed becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def select_sources(df: DataFrame, retailers: list[str] | None = None, categories: list[str] | None = None) -> DataFrame:
    """Rows of the wanted retailers and categories, whatever the case of the names."""
    if retailers:
        df = df.where(F.lower("retailer").isin([r.lower() for r in retailers]))
    if categories:
        df = df.where(F.lower("category").isin([c.lower() for c in categories]))
    return df


def conform(raw: DataFrame, now: datetime) -> DataFrame:
    """Raw columns cast to the record schema, defaults filled in; bad values become NULL.

    Price texts are cleaned. `<name>_given` tells a value that was there but could not be read.
    """
    have = set(raw.columns)
    out: list[Column] = []
    for field in PRICE_SCHEMA:
        name, kind = field.name, field.dataType
        if name not in have:
            value = F.lit(None).cast(kind)
        elif name in ("price", "original_price"):
            is_text = isinstance(raw.schema[name].dataType, T.StringType)
            value = clean_price(F.col(name)) if is_text else nan_to_null(F.col(name))
        elif isinstance(kind, T.MapType):
            value = F.col(name).cast(kind)
        else:
            value = F.col(name).try_cast(kind)
            value = nan_to_null(value) if isinstance(kind, T.DoubleType) else value
        if name == "timestamp":
            value = F.coalesce(value, F.lit(now.isoformat(sep=" ")).cast(kind)) if name not in have else F.when(
                F.col(name).isNull(), F.lit(now.isoformat(sep=" ")).cast(kind)
            ).otherwise(value)
        elif name == "currency":
            value = F.coalesce(value, F.lit("USD"))
        elif name == "in_stock":
            value = F.coalesce(value, F.lit(True))
        out.append(value.alias(name))
    given = [F.col(c).isNotNull().alias(f"{c}_given") for c in _optional_numbers() if c in have]
    return raw.select(*out, *given)


def _optional_numbers() -> list[str]:
    return ["original_price", "quantity", "rating", "review_count"]


def broken_rules(df: DataFrame) -> dict[str, Column]:
    """Record rules by name: true where a conformed row breaks the rule."""

    def number(name: str, ok: Column) -> Column:
        """Optional number: missing is fine, unreadable or out of range is not."""
        given = F.coalesce(F.col(f"{name}_given"), F.lit(False)) if f"{name}_given" in df.columns else F.lit(False)
        return ~F.coalesce(ok, ~given)

    def text_missing(name: str) -> Column:
        return F.coalesce(F.length(name), F.lit(0)) < 1

    return {
        "product_id": text_missing("product_id"),
        "product_name": text_missing("product_name"),
        "price": ~F.coalesce(F.col("price") > 0, F.lit(False)),
        "original_price": number("original_price", F.col("original_price") > 0),
        "category": text_missing("category"),
        "retailer": text_missing("retailer"),
        "url": ~is_valid_url(F.col("url")),
        "timestamp": F.col("timestamp").isNull(),
        "quantity": number("quantity", F.col("quantity") > 0),
        "rating": number("rating", F.col("rating").between(0, 5)),
        "review_count": number("review_count", F.col("review_count") >= 0),
    }


def valid_records(conformed: DataFrame) -> DataFrame:
    """Rows that keep every rule: plain conditions, without building the list of reasons."""
    for broken in broken_rules(conformed).values():
        conformed = conformed.where(~broken)
    return conformed.select(*PRICE_SCHEMA.names)


def judged(conformed: DataFrame) -> DataFrame:
    """Every row with the names of the rules it breaks in `reasons`, and `valid` where it breaks none."""
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in broken_rules(conformed).items()]))
    return conformed.select(*PRICE_SCHEMA.names, reasons.alias("reasons")).withColumn("valid", F.size("reasons") == 0)


def quarantine(conformed: DataFrame) -> DataFrame:
    """Rows that break a rule, with the names of the rules in `reasons`."""
    return judged(conformed).where(~F.col("valid")).drop("valid")


def quarantine_reasons(conformed: DataFrame) -> DataFrame:
    """How many records break each rule."""
    return quarantine(conformed).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def incremental(df: DataFrame, since: datetime | None = None, categories: list[str] | None = None) -> DataFrame:
    """Rows newer than the high-water mark, for some categories if named."""
    if since is not None:
        df = df.where(F.col("timestamp") > ts_like(df, "timestamp", since))
    return select_sources(df, categories=categories)
