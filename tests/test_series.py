from datetime import date

import numpy as np
import pandas as pd
import pytest

from basketflow.operators import series

SCHEMA = "series_id STRING, date DATE, value DOUBLE"


def months(n, start=(2020, 1)):
    return [d.date() for d in pd.date_range(date(*start, 1), periods=n, freq="MS")]


def build(spark, **values):
    rows = [(s, d, None if v is None else float(v)) for s, vs in values.items() for d, v in zip(months(len(vs)), vs)]
    return series.prepare(spark.createDataFrame(rows, SCHEMA))


def test_prepare_drops_missing_and_splits_short(spark):
    p = build(spark, a=[1, None, float("nan")] + list(range(11)), b=range(11))
    assert {r.series_id: r.n for r in p.select("series_id", "n").distinct().collect()} == {"a": 12, "b": 11}
    assert {r.series_id for r in series.long_enough(p).collect()} == {"a"}
    assert [(r.series_id, r.points) for r in series.too_short(p).collect()] == [("b", 11)]
    with pytest.raises(ValueError):
        series.prepare(p, "nope")


def test_moving_average_forecast(spark):
    values = np.random.default_rng(0).normal(50, 5, 30)
    rows = series.moving_average_forecast(build(spark, a=values, b=range(5)), 3).orderBy("step").collect()
    assert [r.date for r in rows] == [date(2022, 7, 1), date(2022, 8, 1), date(2022, 9, 1)]
    level, half = values[-12:].mean(), 1.959963985 * values.std(ddof=1)
    for r in rows:
        assert (r.series_id, r.forecast, r.lower, r.upper) == ("a", *[pytest.approx(x) for x in (level, level - half, level + half)])


def test_daily_axis_goes_on_by_days(spark):
    days = pd.date_range("2024-01-20", periods=14, freq="D")
    p = series.prepare(spark.createDataFrame([("a", d.date(), float(i)) for i, d in enumerate(days)], SCHEMA))
    assert [r.date for r in series.future_axis(series.profile(p), 2).orderBy("step").collect()] == [date(2024, 2, 3), date(2024, 2, 4)]
    assert series.profile(p).first().freq == "D"


def test_gap_in_days_counts_as_monthly(spark):
    days = [date(2024, 1, d) for d in (1, 2, 4)]
    p = series.prepare(spark.createDataFrame([("a", d, 1.0) for d in days], SCHEMA))
    assert series.profile(p).first().freq == "MS"


def reference_backtest(y, test_size, step):
    rows = []
    for i in range(test_size, 0, -step):
        end = len(y) - i
        if end >= 12:
            m, s = np.mean(y[:end][-12:]), np.std(y[:end], ddof=1)
            rows.append((y[end], m, m - 1.959963985 * s, m + 1.959963985 * s))
    return np.array(rows).T


@pytest.mark.parametrize("n,test_size,step", [(36, 12, 1), (20, 12, 1), (40, 10, 3)])
def test_backtest(spark, n, test_size, step):
    y = np.random.default_rng(n).normal(10, 3, n)
    y[-2] = 0.0
    p = build(spark, a=y)
    folds = series.moving_average_folds(p, test_size, step)
    row = series.backtest_metrics(folds, series.test_period(p, test_size)).first()
    a, f, lo, hi = reference_backtest(y, test_size, step)
    e = a - f
    ok = a != 0
    assert row.folds == len(a)
    assert row.rmse == pytest.approx(np.sqrt((e**2).mean())) and row.mae == pytest.approx(abs(e).mean())
    assert row.mape == pytest.approx(abs(e[ok] / a[ok]).mean() * 100)
    assert row.directional_accuracy == pytest.approx((np.sign(np.diff(a)) == np.sign(np.diff(f))).mean())
    assert row.coverage_probability == pytest.approx(((a >= lo) & (a <= hi)).mean())
    assert row.forecast_bias == pytest.approx(e.mean())
    assert row.test_period_start == months(n)[-test_size] and row.test_period_end == months(n)[-1]
    errors = series.backtest_arrays(folds).first().errors
    assert errors == pytest.approx(list(e))


def test_too_few_folds_give_zeros(spark):
    p = build(spark, a=range(13))
    row = series.backtest_metrics(series.moving_average_folds(p), series.test_period(p)).first()
    assert (row.folds, row.rmse, row.coverage_probability) == (1, 0.0, 0.0)


def decompose(y, period=12):
    """Seasonal factors by the textbook steps."""
    n, half = len(y), period // 2
    trend = np.full(n, np.nan)
    for t in range(half, n - half):
        trend[t] = (0.5 * y[t - half] + y[t - half + 1 : t + half].sum() + 0.5 * y[t + half]) / period
    first, last = half, n - 1 - half
    x = np.arange(first, min(first + period, last))
    k, c = np.polyfit(x, trend[x], 1)
    trend[:first] = k * np.arange(first) + c
    x = np.arange(max(first, last - period), last)
    k, c = np.polyfit(x, trend[x], 1)
    trend[last + 1 :] = k * np.arange(last + 1, n) + c
    raw = np.array([np.mean((y / trend)[i::period]) for i in range(period)])
    return np.tile(raw / raw.mean(), n // period + 1)[:n]


@pytest.mark.parametrize("n", [24, 25, 36, 61])
def test_seasonal_adjustment(spark, n):
    t = np.arange(n)
    y = (100 + t) * (1 + 0.1 * np.sin(2 * np.pi * t / 12)) + np.random.default_rng(n).normal(0, 0.5, n)
    rows = series.seasonal_adjust(build(spark, a=y)).orderBy("date").collect()
    factors = decompose(y)
    assert [r.seasonal for r in rows] == pytest.approx(list(factors))
    assert [r.adjusted for r in rows] == pytest.approx(list(y / factors))


@pytest.mark.parametrize("n", [11, 12, 14, 23])
def test_short_series_stay_unadjusted(spark, n):
    rows = series.seasonal_adjust(build(spark, a=range(1, n + 1))).collect()
    assert len(rows) == n and all(r.adjusted == r.value and r.seasonal == 1.0 for r in rows)


def test_ljung_box(spark):
    x = np.random.default_rng(5).normal(size=60)
    row = series.ljung_box(build(spark, a=x, short=range(9))).collect()
    assert len(row) == 1
    e = x - x.mean()
    r = np.array([(e[k:] * e[:-k]).sum() / (e**2).sum() for k in range(1, 11)])
    q = 60 * 62 * (r**2 / (60 - np.arange(1, 11))).sum()
    assert row[0].q == pytest.approx(q)
    draws = np.random.default_rng(0).chisquare(10, 400_000)
    assert row[0].p_value == pytest.approx((draws > q).mean(), abs=0.005)


def test_row_lag_and_chart(spark):
    p = build(spark, a=range(1, 31))
    changed = series.row_lag_change(p, 2).orderBy("pos").collect()
    assert changed[1].change is None and changed[2].change == pytest.approx(200.0)
    forecast = series.moving_average_forecast(p, 2)
    chart = series.chart_series(p, forecast, 24)
    assert {r.kind: r["count"] for r in chart.groupBy("kind").count().collect()} == {"history": 24, "forecast": 2}
    outline = series.band_outline(forecast).first()
    assert outline.x[0] == outline.x[-1] and outline.x[1] == outline.x[2] and outline.y[0] > outline.y[-1]
    table = series.forecast_band_table(forecast).orderBy("month").first()
    assert table.month == "2022-07" and table.upper - table.lower == pytest.approx(3.0)
