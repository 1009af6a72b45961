"""Data quality: one report row per check, expectation rules, summary statistics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.config import QualityConfig
from basketflow.functions.numeric import nan_to_null
from basketflow.functions.text import number, percent_text
from basketflow.functions.timeparts import ts_like
from basketflow.operators import price_jumps
from basketflow.operators.outliers import category_stats, flag_outliers
from basketflow.operators.quantiles import exact_quantiles
from basketflow.session import BROADCAST_ROWS, materialize, stored
from basketflow.sources.storage import comparable

# A row hash that more rows have is hot.
HOT_ROWS = 10_000


def numeric_price(df: DataFrame) -> Column:
    """The price as a number; text that is no number counts as missing."""
    price = F.col("price")
    if isinstance(df.schema["price"].dataType, T.StringType):
        return number(price)
    return nan_to_null(price)


def is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def _row(check: str, severity: str, subject: str, value: Column, threshold, triggered: Column, message: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(severity).alias("severity"),
        F.lit(subject).alias("subject"),
        value.cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
        F.coalesce(triggered, F.lit(False)).alias("triggered"),
        message.alias("message"),
    )


def _count_row(check: str, severity: str, subject: str, n: Column, text: str) -> Column:
    """A check that fires when its count is above zero; `{}` in the text is the count."""
    head, tail = text.split("{}")
    return _row(check, severity, subject, n, 0, n > 0, F.concat(F.lit(head), n.cast("string"), F.lit(tail)))


# The message texts of the checks below.


def schema_check(df: DataFrame, cfg: QualityConfig) -> list[Column]:
    rows = []
    for name in cfg.required_columns:
        missing = name not in df.columns
        rows.append(
            _row("required_column", "error", name, F.lit(int(missing)), 0, F.lit(missing), F.lit(f"Missing required column: {name}"))
        )
    return rows


def _column_facts(df: DataFrame, now: datetime, cfg: QualityConfig) -> dict[str, Column]:
    """The aggregates behind the column checks, by name."""
    have = df.columns
    missing = {c: F.count_if(is_missing(df, c)) for c in have}
    aggs = {"n": F.count(F.lit(1)), **{f"null_{i}": m for i, m in enumerate(missing.values())}}
    if "price" in have:
        price = numeric_price(df)
        aggs |= {
            "p_text": F.count_if(~is_missing(df, "price") & price.isNull()),
            "p_null": F.count_if(price.isNull()),
            "p_low": F.count_if(price < cfg.min_price),
            "p_high": F.count_if(price > cfg.max_price),
            "p_neg": F.count_if(price < 0),
        }
    age = timedelta(hours=cfg.max_data_age_hours)
    if "timestamp" in have:
        ts = F.col("timestamp")
        aggs |= {
            "oldest": F.min(ts),
            "newest": F.max(ts),
            "stale": F.count_if(ts < ts_like(df, "timestamp", now - age)),
        }
    return aggs


def _observed(df: DataFrame, facts: dict[str, Column]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """df, and its aggregates as one row once an action on df has ended. Instants pass as text, and keep their type."""
    seen, kinds = Observation("columns"), df.limit(0).agg(*[v.alias(k) for k, v in facts.items()]).schema
    timed = {f.name for f in kinds if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    metrics = [(v.cast("string") if k in timed else v).alias(k) for k, v in facts.items()]

    def one() -> DataFrame:
        texts = T.StructType([T.StructField(f.name, T.StringType() if f.name in timed else f.dataType) for f in kinds])
        row = df.sparkSession.createDataFrame([tuple(seen.get[k] for k in facts)], texts)
        return row.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds])

    return df.observe(seen, *metrics), one


def column_checks(df: DataFrame, now: datetime, cfg: QualityConfig, one: DataFrame | None = None) -> DataFrame:
    """All checks that need one pass and one aggregate (`one`, where the caller has it)."""
    have, age = df.columns, timedelta(hours=cfg.max_data_age_hours)
    if one is None:
        one = df.agg(*[v.alias(k) for k, v in _column_facts(df, now, cfg).items()])

    n = F.col("n")
    rows = [
        _row("empty", "error", "", n, 0, n == 0, F.lit("DataFrame is empty")),
        *schema_check(df, cfg),
    ]
    if "price" in have:
        rows += [
            _row(
                "data_type", "error", "price", F.col("p_text"), 0, F.col("p_text") > 0,
                F.lit("Column 'price' has invalid data type, expected numeric"),
            ),
            _count_row("null_price", "warning", "price", F.col("p_null"), "Found {} null price values"),
            _count_row("below_min", "warning", "price", F.col("p_low"), f"{{}} prices below minimum threshold ({cfg.min_price})"),
            _count_row("above_max", "warning", "price", F.col("p_high"), f"{{}} prices above maximum threshold ({cfg.max_price})"),
            _count_row("negative_price", "error", "price", F.col("p_neg"), "Found {} negative prices"),
        ]
    nulls = [F.col(f"null_{i}") for i in range(len(have))]
    complete = 1 - F.try_divide(reduce(lambda a, b: a + b, nulls), n * len(have))
    rows.append(
        _row(
            "completeness", "warning", "", complete, cfg.min_completeness_ratio, complete < cfg.min_completeness_ratio,
            F.concat(F.lit("Data completeness ("), percent_text(complete), F.lit(f") below threshold ({cfg.min_completeness_ratio:.2%})")),
        )
    )
    for name, count in zip(have, nulls):
        ratio = F.try_divide(count, n)
        rows.append(
            _row(
                "null_ratio", "warning", name, ratio, cfg.max_null_ratio, ratio > cfg.max_null_ratio,
                F.concat(F.lit(f"Column '{name}' has high null ratio: "), percent_text(ratio)),
            )
        )
    if "timestamp" in have:
        old = F.col("oldest") < ts_like(df, "timestamp", now - age)
        rows += [
            _row("stale", "warning", "timestamp", F.col("stale"), 0, old,
                 F.concat(F.col("stale").cast("string"), F.lit(f" records are older than {age}"))),
            _row("oldest_record", "info", "timestamp", F.lit(None), None, F.lit(False), F.date_format("oldest", "yyyy-MM-dd'T'HH:mm:ss")),
            _row("newest_record", "info", "timestamp", F.lit(None), None, F.lit(False), F.date_format("newest", "yyyy-MM-dd'T'HH:mm:ss")),
        ]
    else:
        rows.append(_row("stale", "warning", "timestamp", F.lit(None), None, F.lit(True), F.lit("No timestamp column found for freshness check")))
    return one.select(F.inline(F.array(*rows)))


def invalid_categories(df: DataFrame, cfg: QualityConfig) -> DataFrame:
    """Category values outside the valid set with their row counts; NULL is not a value."""
    return (
        df.where(F.col("category").isNotNull() & ~F.col("category").isin(list(cfg.valid_categories)))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def exact_duplicates(df: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """One row: rows beyond the first of each identical group.

    A 64-bit row hash is counted first (`hashes`, column _h, where the caller has them); only rows whose hash occurs twice are compared in full.
    Where these hashes are many, whole rows move once, dealt by hash, and meet both the hashes and each other there. Rows of a hash that very many
    rows have are combined before they move.
    """
    keyed = df.select(F.xxhash64(*comparable(df)).alias("_h"), *comparable(df))
    twice = (keyed if hashes is None else hashes).groupBy("_h").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
    kept, rows = materialize(twice)

    def beyond(suspects: DataFrame, *by: str) -> DataFrame:
        return suspects.groupBy(*by, *df.columns).agg(F.count(F.lit(1)).alias("_c")).select((F.col("_c") - 1).alias("_c"))

    if rows <= BROADCAST_ROWS:
        extra = beyond(keyed.join(F.broadcast(kept.select("_h")), "_h", "left_semi")) if rows else kept.select("_c")
    else:
        # Once per so many rows of the repeated hashes a hash can be hot, so at most BROADCAST_ROWS are.
        hot = kept.where(F.col("_c") > max(HOT_ROWS, kept.agg(F.sum("_c")).first()[0] // BROADCAST_ROWS))
        cold = keyed.join(F.broadcast(hot), "_h", "left_anti").join(kept.select("_h").hint("shuffle_hash"), "_h", "left_semi")
        extra = beyond(cold, "_h").unionByName(beyond(keyed.join(F.broadcast(hot), "_h", "left_semi")))
    return extra.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n"))


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows beyond the first of each key; NULL keys are equal to each other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n"))


def quality_report(df: DataFrame, now: datetime, cfg: QualityConfig | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Every check as a row: value, threshold, whether it fired, and its message.

    The source is read once for the column checks and a narrow table of prices, keys and row hashes, and again for the rows whose hash repeats, if any. Price
    digest, ranks, flags, hashes and keys come from the narrow table, the categories from the price statistics (`stats`,
    where the caller has them), which have a row for each.
    """
    cfg = cfg or QualityConfig()
    kept = [c for c in ("category", "product_id", "retailer") if c in df.columns]
    narrow = [*kept, *([numeric_price(df).alias("price")] if "price" in df.columns else []), F.xxhash64(*comparable(df)).alias("_h")]
    observed, one = _observed(df, _column_facts(df, now, cfg))
    facts = stored(observed.select(*narrow), "quality-facts")
    parts = [column_checks(df, now, cfg, one())]

    def counted(one: DataFrame, check: str, severity: str, subject: str, text: str) -> DataFrame:
        return one.select(F.inline(F.array(_count_row(check, severity, subject, F.col("n"), text))))

    if {"price", "category"} <= set(df.columns):
        priced = facts.select("category", "price")
        if stats is None:
            stats, _ = materialize(category_stats(priced))
        flagged = flag_outliers(priced, cfg, stats).agg(F.count_if("is_outlier").alias("n"))
        parts.append(counted(flagged, "outliers", "warning", "price", "Detected {} potential outliers"))
    if "category" in df.columns:
        bad = invalid_categories(facts if stats is None else stats, cfg).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted(bad, "invalid_categories", "warning", "category", "Found {} invalid categories"))
    if {"product_id", "retailer"} <= set(df.columns):
        parts.append(counted(exact_duplicates(df, facts), "exact_duplicates", "warning", "", "Found {} exact duplicate rows"))
        keys = ["product_id", "retailer"]
        parts.append(
            counted(key_duplicates(facts, keys), "key_duplicates", "warning", "product_id, retailer",
                    "Found {} duplicate product_id/retailer combinations")
        )
    return reduce(DataFrame.unionByName, parts)


def incremental_report(new: DataFrame, old: DataFrame, now: datetime, cfg: QualityConfig | None = None) -> DataFrame:
    """The report of the new rows and one more row: prices that jump against the old rows of their product and retailer."""
    jumps = price_jumps.price_jump_warning(price_jumps.price_jumps(new, old, cfg), cfg)
    row = _row("price_jumps", "warning", "price", F.col("jumps"), 0, F.col("jumps") > 0, F.col("message"))
    return quality_report(new, now, cfg).unionByName(jumps.select(F.inline(F.array(row))))


def quality_summary(report: DataFrame) -> DataFrame:
    """One row: valid or not, the fired messages by severity, the outlier count.

    An empty feed yields the one error only.
    """
    empty = F.max(F.when(F.col("check_name") == "empty", F.col("triggered")))

    def fired(severity: str, also: Column = F.lit(True)) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("triggered") & (F.col("severity") == severity) & also, F.col("message"))))

    return report.agg(
        empty.alias("_empty"),
        fired("error").alias("_errors"),
        fired("error", F.col("check_name") == "empty").alias("_empty_error"),
        fired("warning").alias("_warnings"),
        F.max(F.when(F.col("check_name") == "outliers", F.col("value"))).cast("bigint").alias("outlier_count"),
    ).select(
        (F.size("_errors") == 0).alias("is_valid"),
        F.when(F.col("_empty"), F.col("_empty_error")).otherwise(F.col("_errors")).alias("errors"),
        F.when(F.col("_empty"), F.filter("_warnings", lambda _: F.lit(False))).otherwise(F.col("_warnings")).alias("warnings"),
        "outlier_count",
    )


class InvalidData(ValueError):
    """Raised by the gate when the policy is 'raise'."""


def quality_gate(summary: DataFrame, on_invalid: str = "record") -> Row:
    """The one-row summary; raises instead when it holds errors and the policy is 'raise'."""
    row = summary.first()
    if row.errors and on_invalid == "raise":
        raise InvalidData("; ".join(row.errors))
    return row


def summary_stats(df: DataFrame) -> DataFrame:
    """One row: counts of records, products, retailers, categories; mean, median, std, min, max price."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("product_id").alias("unique_products"),
        F.countDistinct("retailer").alias("unique_retailers"),
        F.countDistinct("category").alias("categories"),
    )
    moments = {"price_mean": F.avg("v"), "price_std": F.stddev_samp("v"), "price_min": F.min("v"), "price_max": F.max("v")}
    prices = exact_quantiles(df.select(numeric_price(df).alias("price")), [], "price", [0.5], moments)
    return prices.select(counts.select(F.struct(*counts.columns)).scalar().alias("counts"), "*").select(
        "counts.*", *moments, F.col("q")[0].alias("price_median")
    )


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple[str, ...] = ()


def default_expectations(cfg: QualityConfig | None = None) -> list[Expectation]:
    cfg = cfg or QualityConfig()
    return [
        Expectation("column_to_exist", "price"),
        Expectation("column_to_exist", "product_id"),
        Expectation("column_to_exist", "category"),
        Expectation("values_to_be_between", "price", cfg.min_price, cfg.max_price),
        Expectation("values_to_not_be_null", "product_id"),
        Expectation("values_to_be_in_set", "category", values=cfg.valid_categories),
    ]


def check_expectations(df: DataFrame, rules: list[Expectation] | None = None) -> DataFrame:
    """One row per rule: rows looked at, unexpected rows and their share; one pass for all rules."""
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, rule in enumerate(rules or default_expectations()):
        exists = rule.column in df.columns
        seen, bad = F.lit(0), F.lit(0 if exists else 1)
        if rule.kind != "column_to_exist" and exists:
            c, there = F.col(rule.column), ~is_missing(df, rule.column)
            if rule.kind == "values_to_not_be_null":
                broken, looked = ~there, F.lit(True)
            elif rule.kind == "values_to_be_between":
                broken, looked = there & ~c.between(rule.low, rule.high), there
            else:
                broken, looked = there & ~c.isin(list(rule.values)), there
            aggs += [F.count_if(broken).alias(f"bad_{i}"), F.count_if(looked).alias(f"seen_{i}")]
            seen, bad = F.col(f"seen_{i}"), F.col(f"bad_{i}")
        rows.append(
            F.struct(
                F.lit(rule.kind).alias("expectation"),
                F.lit(rule.column).alias("column"),
                (bad == 0).alias("success"),
                seen.cast("bigint").alias("element_count"),
                bad.cast("bigint").alias("unexpected_count"),
                F.coalesce(F.try_divide(bad, seen) * 100, F.lit(0.0)).alias("unexpected_percent"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def suite_result(results: DataFrame) -> DataFrame:
    """One row for the whole suite: whether all rules hold, how many there are and how many hold, and their share in percent."""
    held = F.count_if("success")
    return results.agg(
        F.every("success").alias("success"), F.count(F.lit(1)).alias("evaluated"), held.alias("successful"),
        (F.count(F.lit(1)) - held).alias("unsuccessful"), (F.try_divide(held, F.count(F.lit(1))) * 100).alias("success_percent"),
    )
