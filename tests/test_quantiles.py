import numpy as np
import pytest

from basketflow.operators import quantiles
from basketflow.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def check(spark, groups, probs=PROBS):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    got = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g STRING, x DOUBLE"), ["g"], "x", probs).collect()}
    for g, values in groups.items():
        assert got[g].n == len(values)
        assert got[g].q == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-12), g


def test_small_and_odd_groups(spark):
    check(spark, {"one": [5], "two": [1, 2], "four": [1, 2, 4, 9], "ties": [3] * 50, "mixed": [0] * 40 + [1] + [7] * 40, "neg": [-5, -1, 0, 2.5]})


def test_every_length(spark):
    rng = np.random.default_rng(1)
    check(spark, {str(n): rng.normal(size=n) for n in (*range(1, 30), 999, 1000, 1001, 7999, 8000, 8001)}, [0.25, 0.5, 0.75])


def test_random_groups(spark):
    rng = np.random.default_rng(7)
    check(spark, {"normal": rng.normal(size=20000), "tail": rng.lognormal(0, 3, size=17001), "cents": rng.integers(1, 500, size=19000) / 100, "few": rng.integers(0, 3, size=4000)})


def test_wide_brackets_and_few_bins(spark, monkeypatch):
    """Coarse digests put many values between the brackets and in shared bins."""
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    monkeypatch.setattr(quantiles, "HALF_WIDTH", 0.1)
    monkeypatch.setattr(quantiles, "BINS", 4)
    rng = np.random.default_rng(3)
    check(spark, {"a": rng.normal(size=6000), "b": rng.integers(0, 40, size=6000)}, [0.25, 0.3, 0.75])


def test_nulls_are_left_out(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), (None, 9.0), ("b", None)]
    out = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g STRING, x DOUBLE"), ["g"], "x", [0.5]).collect()}
    assert out["a"].q == [2.0] and out["a"].n == 2 and set(out) <= {"a", "b"} and (("b" not in out) or out["b"].n == 0)


def test_without_groups(spark):
    values = np.random.default_rng(8).normal(size=9001)
    df = spark.createDataFrame([(float(v),) for v in values], "x DOUBLE")
    row = exact_quantiles(df, [], "x", [0.1, 0.5]).first()
    assert row.n == 9001 and row.q == pytest.approx(list(np.quantile(values, [0.1, 0.5])))
    assert exact_quantiles(df.limit(0), [], "x", [0.5]).first().q is None
