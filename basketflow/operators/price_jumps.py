"""Price jumps of new rows against the distinct old prices of the same product and retailer.

Every (new row, old price) pair counts, but no pair is built: |new - old| / |old| stays within
the threshold exactly for the old prices of one interval around the new price, so the pairs
within it are two ranks in the ordered old prices.
"""

from __future__ import annotations

import math
import sys
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.config import QualityConfig
from basketflow.session import stored

KEYS = ["product_id", "retailer"]
BINS_PER_LOG = 64
MASK_STEPS = 25  # masks stay below 2**53, where doubles are exact


def _within(size: Column, old: Column, threshold: float) -> Column:
    return F.abs(F.try_divide(size - old, old)) <= threshold


def _run_mask(near: Column, size: Column, threshold: float, steps: int, answer: bool) -> Column:
    """Bit k is set where the k-th double around the edge `near` gives the answer."""
    olds = [near + near * (k * 2.0**-53) for k in range(-steps, steps + 1)]
    bits = [F.when(_within(size, old, threshold) == answer, F.lit(1 << k)).otherwise(F.lit(0)) for k, old in enumerate(olds)]
    return reduce(lambda a, b: a + b, bits)


def _turns(near: Column, size: Column, threshold: float, steps: int) -> Column:
    """Every place around the edge where the answer turns, for any pattern of answers.

    A turn from yes to no adds the old prices up to it, a turn from no to yes takes them away.
    """
    olds = F.transform(F.sequence(F.lit(-steps), F.lit(steps)), lambda k: near + near * k * F.lit(2.0**-53))
    asked = F.transform(
        olds, lambda old: F.struct(old.alias("at"), _within(size, old, threshold).cast("bigint").alias("yes"))
    )
    pairs = F.zip_with(
        F.slice(asked, 1, 2 * steps),
        F.slice(asked, 2, 2 * steps),
        lambda a, b: F.struct(a["at"].alias("at"), ((a["yes"] - b["yes"]) * F.col("c")).alias("w")),
    )
    return F.filter(pairs, lambda p: p["w"] != 0)


def _edge(near: Column, size: Column, threshold: float, steps: int, mask: str, weight: int) -> Column:
    """Probes of one edge: mostly a single one, behind the last bit of an unbroken run.

    Rounding blurs an edge by a few units in the last place, and there the answer may turn more
    than once; then all its turns are listed.
    """
    turns = _turns(near, size, threshold, steps)
    if steps > MASK_STEPS:
        return turns
    run = F.bit_count(mask)
    last = near + near * (run - 1 - steps) * F.lit(2.0**-53)
    unbroken = F.col(mask) + 1 == F.pow(F.lit(2.0), run)
    return F.when(unbroken, F.array(F.struct(last.alias("at"), (weight * F.col("c")).alias("w")))).otherwise(turns)


def _priced(df: DataFrame) -> DataFrame:
    price = F.col("price").cast("double")
    return df.select(*KEYS, price.alias("price")).where(price.isNotNull() & ~F.isnan(price))


def price_jumps(new: DataFrame, old: DataFrame, cfg: QualityConfig | None = None) -> DataFrame:
    """(product_id, retailer) -> pairs compared and pairs that jump; keys on both sides only."""
    threshold = (cfg or QualityConfig()).price_change_threshold
    # Stored, since both are read several times and what they come from may be costly.
    fresh = stored(_priced(new).groupBy(*KEYS, "price").agg(F.count(F.lit(1)).alias("c")), "new-prices")
    past = stored(_priced(old).distinct(), "old-prices")
    sign, size = F.signum("price").alias("sign"), F.abs("price")

    if 0 < threshold < 1e-9:
        raise ValueError("a threshold this small cannot be told from rounding")
    bounds = {"low": (size / (1 + threshold), 4, False, -1)}
    if 0 < threshold < 1:  # at 0 both edges are the new price itself
        # The closer to 1, the softer the upper edge.
        bounds["high"] = (size / (1 - threshold), 4 + math.ceil(2 * threshold / (1 - threshold)), True, 1)
    masks, edges = {}, []
    for mask, (near, steps, answer, weight) in bounds.items():
        if steps <= MASK_STEPS:
            masks[mask] = _run_mask(near, size, threshold, steps, answer)
        edges.append(_edge(near, size, threshold, steps, mask, weight))
    if threshold == 1:  # no higher old price is ever a jump
        edges.append(F.array(F.struct(F.lit(sys.float_info.max).alias("at"), F.col("c").alias("w"))))
    # On equal values an old price comes before the probe that counts up to it.
    olds = past.where("price != 0").select(*KEYS, sign, size.alias("at"), F.lit(1).alias("old"), F.lit(0).cast("bigint").alias("w"))
    probes = fresh.where("price != 0").withColumns(masks).select(*KEYS, sign, F.inline(F.concat(*edges))).withColumn("old", F.lit(0))
    events = olds.unionByName(probes)
    events = events.withColumn("bin", F.floor(F.ln("at") * BINS_PER_LOG))
    # Bins of the price axis split a hot key: ranks are counted inside a bin, and the old prices
    # of the lower bins are added for the bin as a whole.
    inside = W.partitionBy(*KEYS, "sign", "bin").orderBy("at", F.col("old").desc()).rowsBetween(W.unboundedPreceding, 0)
    bins = (
        events.withColumn("rank", F.sum("old").over(inside))
        .groupBy(*KEYS, "sign", "bin")
        .agg(F.sum("old").alias("olds"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("rank")).alias("ranked"))
    )
    lower = W.partitionBy(*KEYS, "sign").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("olds").over(lower), F.lit(0))
    near = bins.select(*KEYS, (F.col("ranked") + F.col("w") * before).alias("near")).groupBy(*KEYS).agg(F.sum("near").alias("near"))
    zero = F.col("price") == 0
    new_total = fresh.groupBy(*KEYS).agg(
        F.sum("c").alias("n"), F.coalesce(F.sum(F.when(zero, F.col("c"))), F.lit(0)).alias("n_zero")
    )
    old_total = past.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("m"), F.count_if(zero).alias("m_zero"))
    # 0 against 0 is no jump; 0 against another price is a change of exactly 100 %.
    still = F.col("n_zero") * (F.col("m_zero") if threshold < 1 else F.col("m"))
    pairs = F.col("n") * F.col("m")
    return (
        new_total.join(old_total, KEYS)
        .join(near, KEYS, "left")
        .select(*KEYS, pairs.alias("pairs"), (pairs - F.coalesce("near", F.lit(0)) - still).alias("jumps"))
    )


def price_jump_warning(jumps: DataFrame, cfg: QualityConfig | None = None) -> DataFrame:
    """One row: number of jumps and the warning text, NULL when there is none."""
    threshold = (cfg or QualityConfig()).price_change_threshold
    n = F.col("jumps")
    text = F.concat(n.cast("string"), F.lit(f" products have suspicious price changes (>{threshold:.0%})"))
    return jumps.agg(F.coalesce(F.sum("jumps"), F.lit(0)).alias("jumps")).select(n, F.when(n > 0, text).alias("message"))
