"""Numeric column expressions and the quantiles used as constants."""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import chain
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketflow.schema import UNIT_MULTIPLIERS


def nan_to_null(c: Column) -> Column:
    """NaN counts as missing everywhere in the jobs."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def unit_price(price: Column, unit: Column, quantity: Column) -> Column:
    """Price per standard unit where unit and quantity are given, else the price."""
    pairs = chain.from_iterable((F.lit(u), F.lit(m)) for u, m in UNIT_MULTIPLIERS.items())
    factor = F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(unit)), F.lit(1.0))
    return F.when((unit != "") & (quantity != 0), F.try_divide(price * factor, quantity)).otherwise(price)


def pct_change(new: Column, old: Column) -> Column:
    return (F.try_divide(new, old) - 1) * 100


def change_from_base(value: Column, base: float = 100.0) -> Column:
    """Percent change against a base value; 0 for a base that is not positive."""
    base_col = F.lit(float(base))
    return F.when(base_col > 0, (F.try_divide(value, base_col) - 1) * 100).otherwise(F.lit(0.0))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over the pairs; NULL where a side does not vary (`corr` would fail)."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def normal_quantile(confidence: float) -> float:
    """Two-sided normal quantile: 1.959964 for 0.95."""
    return NormalDist().inv_cdf((1 + confidence) / 2)


@lru_cache(maxsize=256)
def t_quantile(confidence: float, dof: int) -> float:
    """Two-sided Student quantile, by bisection on the integrated density."""
    scale = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)

    def mass(upper: float, steps: int = 2000) -> float:
        h = upper / steps
        total = 0.0
        for i in range(steps + 1):
            weight = 1 if i in (0, steps) else (4 if i % 2 else 2)
            total += weight * (1 + (i * h) ** 2 / dof) ** (-(dof + 1) / 2)
        return 2 * scale * total * h / 3

    lo, hi = 0.0, 1.0
    while mass(hi) < confidence:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mass(mid) < confidence else (lo, mid)
    return (lo + hi) / 2
