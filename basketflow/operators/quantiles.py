"""Exact quantiles per group without gathering a group in one task.

The built-in `percentile` keeps every distinct value of a group in one buffer. Here an
approximate digest first yields a narrow bracket around each wanted rank. A second pass
counts what lies between the brackets and keeps only the values inside them, cut into small
bins. Ranks then follow from running counts over bins and inside a bin. A missed bracket
raises an error; it never gives a wrong value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.session import join_checked, materialize

ACCURACY = 10_000
HALF_WIDTH = 5 / ACCURACY  # five times the error of the digest
BINS = 1_000


def exact_quantiles(
    df: DataFrame, group: list[str], value: str, probs: list[float], also: dict[str, Column] | None = None
) -> DataFrame:
    """One row per group: the group columns, `n` non-null values and `q` (array, linear interpolation).

    Group keys that are NULL are left out, as are NULL values. Without group columns there is one
    row. `also` names further aggregates (over all rows of the group, the value being `v`) that
    come with the first pass.
    """
    also = also or {}
    rows = df.select(*group, F.col(value).cast("double").alias("v"))
    for key in group:
        rows = rows.where(F.col(key).isNotNull())
    edges = [e for p in probs for e in (max(p - HALF_WIDTH, 0.0), min(p + HALF_WIDTH, 1.0))]
    cuts = rows.groupBy(*group).agg(
        F.count("v").alias("n"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
        F.percentile_approx("v", edges, ACCURACY).alias("cut"),
        *[agg.alias(name) for name, agg in also.items()],
    )
    # In a small group, or next to an end, a wanted rank may lie outside the digest's bracket:
    # there the bracket is opened up to the end.
    small = F.col("n") * HALF_WIDTH < 4
    lows = [F.when(small | F.lit(edges[2 * j] == 0), F.col("lowest")).otherwise(F.col("cut")[2 * j]) for j in range(len(probs))]
    highs = [
        F.when(small | F.lit(edges[2 * j + 1] == 1), F.col("highest")).otherwise(F.col("cut")[2 * j + 1]) for j in range(len(probs))
    ]
    cuts, _ = materialize(cuts.select(*group, "n", F.array(*lows).alias("low"), F.array(*highs).alias("high"), *also))

    # Each row: its region on the axis, and its value only where it lies inside a bracket.
    v, size = F.col("v"), range(len(probs))
    region = reduce(
        lambda a, b: a + b, [(v >= F.col("low")[j]).cast("int") + (v > F.col("high")[j]).cast("int") for j in size]
    )
    inside = reduce(lambda a, b: a | b, [v.between(F.col("low")[j], F.col("high")[j]) for j in size])
    bin_no = reduce(
        lambda rest, j: F.when(
            v.between(F.col("low")[j], F.col("high")[j]),
            F.floor(F.try_divide(v - F.col("low")[j], F.col("high")[j] - F.col("low")[j]) * (BINS - 1)),
        ).otherwise(rest),
        reversed(size),
        F.lit(None),
    )
    placed = _with_brackets(rows.where(v.isNotNull()), cuts, group).select(
        *group,
        region.alias("region"),
        F.when(inside, F.coalesce(bin_no, F.lit(0))).otherwise(-1).cast("int").alias("bin"),
        F.when(inside, v).alias("v"),
    )
    counted = placed.groupBy(*group, "region", "bin", "v").agg(F.count(F.lit(1)).alias("c"))
    by_bin = counted.groupBy(*group, "region", "bin").agg(F.sum("c").alias("bin_c"))
    earlier = W.partitionBy(*group).orderBy("region", "bin").rowsBetween(W.unboundedPreceding, -1)
    by_bin = by_bin.withColumns(
        {"before": F.coalesce(F.sum("bin_c").over(earlier), F.lit(0)), "n": F.sum("bin_c").over(W.partitionBy(*group))}
    )
    within = W.partitionBy(*group, "region", "bin").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    upto = F.col("before") + F.col("running")
    ranked = (
        counted.withColumn("running", F.sum("c").over(within))
        .join(by_bin.drop("bin_c"), [*group, "region", "bin"])
        .withColumn("first", upto - F.col("c"))
        .withColumn("last", upto - 1)
    )
    position = [F.lit(p) * (F.col("n") - 1) for p in probs]
    ranks = [(F.floor(x), F.ceil(x)) for x in position]
    picks = []
    for j, pair in enumerate(ranks):
        for side, rank in zip(("lo", "hi"), pair):
            hit = (F.col("first") <= rank) & (rank <= F.col("last"))
            picks.append(F.max(F.when(hit, F.col("v"))).alias(f"{side}{j}"))
    picked = ranked.groupBy(*group, "n").agg(*picks)
    out = []
    for j, x in enumerate(position):
        lo, hi, part = F.col(f"lo{j}"), F.col(f"hi{j}"), x - F.floor(x)
        out.append(
            F.when(lo.isNull() | hi.isNull(), F.raise_error(F.lit("quantile bracket missed")).cast("double")).otherwise(
                lo + (hi - lo) * part
            )
        )
    quantiles = picked.select(*group, F.array(*out).alias("q"))
    if not group:
        return cuts.select("n", *also, quantiles.scalar().alias("q"))
    return cuts.select(*group, "n", *also).join(quantiles, group, "left")


def _with_brackets(rows: DataFrame, cuts: DataFrame, group: list[str]) -> DataFrame:
    """Rows with the brackets of their group; without groups the one row of brackets is a constant."""
    if group:
        return join_checked(rows, cuts.select(*group, "low", "high"), group, "inner")
    one = cuts.first()
    return rows.withColumns({name: F.array(*[F.lit(x).cast("double") for x in one[name]]) for name in ("low", "high")})
