import numpy as np
import pytest

from basketflow.operators.compare import comparison_metrics, lead_lag_correlation, official_yoy

SCHEMA = "date DATE, price_index DOUBLE, cpi_value DOUBLE"


def aligned(spark, a, b):
    from datetime import date

    return spark.createDataFrame([(date(2024, 1 + i, 1), float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))], SCHEMA)


def test_metrics(spark):
    a, b = np.array([100, 102, 101, 105.0]), np.array([99, 103, 100, 107.0])
    row = comparison_metrics(aligned(spark, a, b)).first()
    d = a - b
    assert row.correlation == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert (row.rmse, row.mae, row.bias, row.tracking_error) == pytest.approx((np.sqrt((d**2).mean()), abs(d).mean(), d.mean(), d.std()))


def test_one_point_gives_zeros(spark):
    row = comparison_metrics(aligned(spark, [1], [2])).first()
    assert (row.correlation, row.rmse, row.mae, row.bias, row.tracking_error) == (0.0,) * 5


def test_a_constant_side_has_no_correlation(spark):
    row = comparison_metrics(aligned(spark, [100, 100, 100], [1, 2, 3])).first()
    assert row.correlation is None and row.bias == pytest.approx(98.0)


def test_lags(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=9), rng.normal(size=9)
    got = {r.lag: r.correlation for r in lead_lag_correlation(aligned(spark, a, b)).collect()}
    for lag in range(-4, 5):
        x, y = (a[:lag], b[-lag:]) if lag < 0 else (a[lag:], b[: len(b) - lag])
        assert got[lag] == pytest.approx(np.corrcoef(x, y)[0, 1]), lag


def test_lags_beyond_the_length_are_null(spark):
    got = {r.lag: r.correlation for r in lead_lag_correlation(aligned(spark, [1, 2, 4], [2, 3, 9])).collect()}
    assert got[4] is None and got[-3] is None and got[0] is not None


def test_official_change(spark):
    df = spark.createDataFrame([(103.0,)], "cpi_value DOUBLE")
    assert official_yoy(df).first().yoy_change == pytest.approx(3.0)
