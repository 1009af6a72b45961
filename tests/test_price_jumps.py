import random

import pytest

from basketflow.config import QualityConfig
from basketflow.operators.price_jumps import price_jump_warning, price_jumps

COLUMNS = "product_id STRING, retailer STRING, price DOUBLE"


def brute(new, old, threshold):
    out = {}
    past = {(p, r, x) for p, r, x in old if x is not None}
    for p, r, n in new:
        for q, s, o in past:
            if (p, r) == (q, s) and n is not None:
                pairs, jumps = out.get((p, r), (0, 0))
                jump = (n != 0) if o == 0 else abs((n - o) / o) > threshold
                out[p, r] = (pairs + 1, jumps + jump)
    return out


def run(spark, new, old, threshold=0.5):
    cfg = QualityConfig(price_change_threshold=threshold)
    jumps = price_jumps(spark.createDataFrame(new, COLUMNS), spark.createDataFrame(old, COLUMNS), cfg)
    return {(r.product_id, r.retailer): (r.pairs, r.jumps) for r in jumps.collect()}


def test_hand_made(spark):
    old = [("a", "r", 10.0), ("a", "r", 10.0), ("a", "r", 4.0), ("b", "r", 0.0), ("c", "r", 5.0), ("a", "s", None)]
    new = [("a", "r", 15.0), ("a", "r", 15.01), ("a", "r", 5.0), ("b", "r", 0.0), ("b", "r", 1.0), ("d", "r", 1.0), ("a", "s", 3.0)]
    assert run(spark, new, old) == brute(new, old, 0.5) == {("a", "r"): (6, 3), ("b", "r"): (2, 1)}


@pytest.mark.parametrize("threshold", [0.0, 0.1, 0.5, 0.9, 0.99, 1.0])
def test_against_brute_force(spark, threshold):
    rng = random.Random(5)
    grid = [k / 100 for k in range(1, 60)] + [0.0, -0.2, -0.3, 10.0, 15.0, 5.0]
    rows = lambda n: [(rng.choice("ab"), rng.choice("rs"), rng.choice(grid)) for _ in range(n)]
    new, old = rows(150), rows(150)
    assert run(spark, new, old, threshold) == brute(new, old, threshold)


def test_exact_edges(spark):
    """Ratios that hit the threshold up to rounding."""
    rng = random.Random(11)
    old, new = [], []
    for i in range(300):
        o = round(rng.uniform(0.01, 1000), 2)
        old.append((str(i % 7), "r", o))
        new += [(str(i % 7), "r", o * 1.3), (str(i % 7), "r", o * 0.7), (str(i % 7), "r", o / 0.7)]
    assert run(spark, new, old, 0.3) == brute(new, old, 0.3)


def test_no_pairs_are_built(spark):
    df = spark.createDataFrame([("a", "r", 1.0)], COLUMNS)
    plan = price_jumps(df, df)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_warning(spark):
    new, old = [("a", "r", 20.0)], [("a", "r", 10.0)]
    jumps = price_jumps(spark.createDataFrame(new, COLUMNS), spark.createDataFrame(old, COLUMNS))
    assert price_jump_warning(jumps).first().message == "1 products have suspicious price changes (>50%)"
