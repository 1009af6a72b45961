"""Fitted models against plain loops and numpy's least squares."""

from __future__ import annotations

import datetime
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.config import ForecastConfig
from basketflow.functions import linear
from basketflow.operators import arima, forecast, series, smoothing

DAY = datetime.date(1990, 1, 1)
PLAIN = ForecastConfig(seasonal_order=(0, 0, 0))
AR_LAGS, LONG = 2, arima.LONG


def _arma(rng, n, summed):
    e, w = rng.normal(size=n + 2), np.zeros(n + 2)
    for t in range(2, n + 2):
        w[t] = 0.6 * w[t - 1] + e[t] + 0.4 * e[t - 1]
    return (np.cumsum(w[2:]) + 100 if summed else w[2:] + 50).tolist()


def _seasonal(rng, n):
    return [float(100 + 0.1 * i + 3 * np.sin(i / 12 * 2 * np.pi) + rng.normal()) for i in range(n)]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(11)
    return {
        "level": _arma(rng, 200, False), "walk": _arma(rng, 150, True), "season": _seasonal(rng, 96), "short": _seasonal(rng, 20),
        "tiny": _seasonal(rng, 7), "constant": [5.0] * 40,
    }


@pytest.fixture(scope="module")
def prepared(spark, values):
    rows = [(k, DAY + datetime.timedelta(days=i), v) for k, vs in values.items() for i, v in enumerate(vs)]
    return series.prepare(spark.createDataFrame(rows, "series_id string, date date, value double")).cache()


def least_squares(x, y):
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    return b, float(((y - x @ b) ** 2).sum())


def test_linear_algebra(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 5))
    y = x @ np.arange(1, 6) + rng.normal(size=50)
    rows = [("a", [*map(float, r), float(v)]) for r, v in zip(x, y)] + [("dependent", [1.0, 2.0 * i, 4.0 * i, float(i * i)]) for i in range(9)]
    table = spark.createDataFrame(rows, "k string, terms array<double>")
    found = linear.gram(linear.gram_cells(table, ["k"]), ["k"]).withColumn("f", linear.let(F.col("gram"), lambda m: linear.cholesky(m, F.col("size"))))
    found = {r.k: r for r in found.withColumn("b", linear.let(F.col("f"), lambda f: linear.solved(f, F.col("size") - 1))).collect()}
    b, rss = least_squares(x, y)
    assert np.allclose(found["a"].b, b) and np.isclose(found["a"].f[-1][-1] ** 2, rss)
    assert found["dependent"].b[-1] is None


# --- Holt-Winters


def holt_winters(y, alpha, beta, gamma, m=12):
    level = np.mean(y[:m])
    trend, season, sse = (np.mean(y[m : 2 * m]) - level) / m, [v - level for v in y[:m]], 0.0
    for v in y[m:]:
        e = v - level - trend - season[0]
        level, trend = level + trend + alpha * e, trend + alpha * beta * e
        season, sse = season[1:] + [season[0] + gamma * e], sse + e * e
    return sse, [level, trend, *season]


@pytest.mark.parametrize("length, period", [(1, 12), (5, 12), (64, 12), (7, 4), (200, 7)])
def test_chunks_compose_to_the_plain_recursion(prepared, values, length, period):
    rows = {r.series_id: r for r in smoothing.fixed(prepared, 0.3, 0.1, 0.2, period=period, length=length).collect()}
    assert set(rows) == {k for k, v in values.items() if len(v) >= 2 * period}
    for k, r in rows.items():
        sse, state = holt_winters(values[k], 0.3, 0.1, 0.2, period)
        assert np.isclose(r.sse, sse, atol=1e-9) and np.allclose(r.state, state, atol=1e-9)


def test_weights_minimise_the_squared_error_on_every_grid(prepared, values):
    def allowed(w):
        return all(0 < v < 1 for v in w) and round(w[0] + w[2], 6) <= 1

    rows = {r.series_id: r for r in smoothing.fitted(prepared.where("series_id in ('season', 'walk')")).collect()}
    assert set(rows) == {"season", "walk"}
    for k, r in rows.items():
        tried = [w for w in itertools.product(smoothing.GRID, repeat=3) if allowed(w)]
        for step in (*smoothing.ROUNDS, None):
            best = min((holt_winters(values[k], *w)[0], w) for w in tried)[1]
            if step:
                tried = [w for w in (tuple(round(v + d * step, 6) for v, d in zip(best, ds)) for ds in itertools.product((-1, 0, 1), repeat=3)) if allowed(w)]
        assert (r.alpha, r.beta, r.gamma) == best


def test_band_of_the_smoothing(prepared, values):
    cfg = ForecastConfig(model_type="ets", horizon=30)
    rows = forecast.ets_forecast(prepared, cfg, smoothing.fixed(prepared, 0.3, 0.1, 0.2)).collect()
    of = {(r.series_id, r.step): r for r in rows}
    assert {k for k, _ in of} == {k for k, v in values.items() if len(v) >= 12}
    assert {r.series_id for r in rows if r.model == "moving_average"} == {"short"}
    sse, state = holt_winters(values["season"], 0.3, 0.1, 0.2)
    spread = 1.0
    for h in range(1, 31):
        r = of["season", h]
        assert np.isclose(r.forecast, state[0] + h * state[1] + state[2 + (h - 1) % 12])
        assert np.isclose(r.upper - r.forecast, 1.959963984540054 * np.sqrt(sse / (96 - 12) * spread)) and np.isclose(r.forecast - r.lower, r.upper - r.forecast)
        assert r.date == DAY + datetime.timedelta(days=95 + h)
        spread += (0.3 * (1 + 0.1 * h) + (0.2 if h % 12 == 0 else 0)) ** 2


# --- unit roots


def dickey_fuller(y):
    y, n = np.array(y), len(y)
    dy, most = np.diff(y), min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)

    def design(lags, first):
        return np.array([[1, y[t], *[dy[t - i] for i in range(1, lags + 1)]] for t in range(first, len(dy))]), dy[first:]

    def aic(lags):
        x, r = design(lags, most)
        return len(r) * np.log(least_squares(x, r)[1] / len(r)) + 2 * (lags + 2)

    lags = min(range(most + 1), key=aic)
    x, r = design(lags, lags)
    b, rss = least_squares(x, r)
    return lags, b[1] / np.sqrt(rss / (len(r) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])


def test_unit_root_test(prepared, values):
    rows = {r.series_id: r for r in arima.adf(prepared).collect()}
    assert set(rows) == set(values)
    for k in ("level", "walk", "season", "short", "tiny"):
        lags, tau = dickey_fuller(values[k])
        assert rows[k].lags == lags and np.isclose(rows[k].tau, tau, rtol=1e-7), k
        assert rows[k].stationary == (tau < arima.critical_tau()) and rows[k].d == int(not rows[k].stationary)
    assert rows["level"].stationary and not rows["walk"].stationary
    assert (rows["constant"].tau, rows["constant"].d) == (None, 1)
    assert round(arima.critical_tau(), 2) == -2.86


# --- ARIMA


def hannan_rissanen(y, d, season):
    """aic, coefficients of all nine orders."""
    w = np.diff(y) if d else np.array(y)
    w = w[season:] - w[:-season] if season else w
    w = w - w.mean()
    extra = [season] if season else []
    long = [k for k in range(1, LONG + 1) if k != season] + extra
    first, n = max(long) + max([AR_LAGS, *extra]), len(w)
    a = least_squares(np.array([[1, *[w[t - k] for k in long]] for t in range(first, n)]), w[first:])[0]
    e = {t: w[t] - a[0] - sum(c * w[t - k] for c, k in zip(a[1:], long)) for t in range(max(long), n)}
    out = {}
    for p, q in itertools.product(range(3), repeat=2):
        x = np.array([[1, *[w[t - k] for k in [*range(1, p + 1), *extra]], *[e[t - k] for k in [*range(1, q + 1), *extra]]] for t in range(first, n)])
        b, rss = least_squares(x, w[first:])
        out[p, q] = ((n - first) * np.log(rss / (n - first)) + 2 * (x.shape[1] + 1), b)
    return out


@pytest.mark.parametrize("season", [0, 12])
def test_all_orders_from_one_matrix(prepared, values, season):
    kept = ["level", "walk", "season"]
    source = arima.listed(prepared).where(F.col("series_id").isin(kept)).withColumn("d", (F.col("series_id") == "walk").cast("int"))
    rows = arima.orders(source, season=season).collect()
    assert len(rows) == 27
    for r in rows:
        aic, b = hannan_rissanen(values[r.series_id], r.series_id == "walk", season)[r.p, r.q]
        assert np.isclose(r.aic, aic, rtol=1e-8) and np.allclose(r.coefficients, b, atol=1e-7)
        ma = b[r.p + 1 + bool(season) :]
        assert r.fits == (np.abs(ma).sum() < 1)


@pytest.mark.parametrize("season", [0, 12])
def test_forecast_follows_the_difference_equation(prepared, values, season):
    models = arima.ahead(arima.fitted(prepared.where("series_id = 'walk'"), 1, season=season), 15)
    r = models.first()
    y = list(values["walk"])
    back = {1: 1.0} if not season else {1: 1.0, season: 1.0, season + 1: -1.0}
    w = [y[t] - sum(c * y[t - k] for k, c in back.items()) for t in range(max(back), len(y))]
    mid = np.mean(w)
    w = [v - mid for v in w]
    span, e = len(r.phi), []
    for t in range(len(w)):
        known = w[t] - r.constant - sum(r.phi[k - 1] * w[t - k] + r.theta[k - 1] * e[t - k] for k in range(1, span + 1)) if t >= span else 0.0
        e.append(known)
    assert np.allclose(r.errors, e[span:]) and np.isclose(r.sse, sum(v * v for v in e))
    for _ in range(15):
        new = r.constant + sum(r.phi[k - 1] * w[-k] + r.theta[k - 1] * e[-k] for k in range(1, span + 1))
        w.append(new)
        e.append(0.0)
        y.append(new + mid + sum(c * y[-k] for k, c in back.items()))
    assert np.allclose(r.forecast, y[-15:])
    # Response to one shock through the product of the AR and difference polynomials.
    ar = np.r_[1.0, -np.array(r.phi)]
    diff = np.zeros(max(back) + 1)
    diff[0] = 1
    for k, c in back.items():
        diff[k] -= c
    whole = np.convolve(ar, diff)
    psi = []
    for j in range(15):
        psi.append((1.0 if j == 0 else r.theta[j - 1] if j <= span else 0.0) - sum(whole[k] * psi[j - k] for k in range(1, min(j, len(whole) - 1) + 1)))
    assert np.allclose(r.se, np.sqrt(r.sse / len(r.errors) * np.cumsum(np.square(psi))))
    assert all(a < b for a, b in zip(r.se, r.se[1:]))


def test_series_that_cannot_be_solved_take_the_moving_average(prepared, values):
    rows = forecast.forecast(prepared, PLAIN).collect()
    models = {r.series_id: r.model for r in rows}
    assert set(models) == {k for k, v in values.items() if len(v) >= 12}
    assert models["constant"] == "moving_average" and models["level"] == models["walk"] == models["season"] == "arima"
    assert all(r.forecast == r.lower == r.upper == 5.0 for r in rows if r.series_id == "constant")
    assert len(rows) == 12 * len(models)


def test_given_order_and_ensemble(prepared):
    some = prepared.where("series_id in ('season', 'walk')")
    cfg = ForecastConfig(auto_order=False, arima_order=(1, 1, 1), seasonal_order=(0, 0, 0))
    model = {r.series_id: (r.p, r.d, r.q) for r in forecast.arima_models(some, cfg).collect()}
    assert set(model.values()) == {(1, 1, 1)}
    both = ForecastConfig(model_type="ensemble", horizon=3)
    got = {(r.series_id, r.step): r for r in forecast.forecast(some, both).collect()}
    a = {(r.series_id, r.step): r for r in forecast.forecast(some, ForecastConfig(horizon=3)).collect()}
    b = {(r.series_id, r.step): r for r in forecast.forecast(some, ForecastConfig(model_type="ets", horizon=3)).collect()}
    assert got.keys() == a.keys() == b.keys()
    for k, r in got.items():
        assert np.allclose([r.forecast, r.lower, r.upper], [(getattr(a[k], c) + getattr(b[k], c)) / 2 for c in forecast.BAND]) and r.model == "ensemble"
    alias = {(r.series_id, r.step): r.forecast for r in forecast.forecast(some, ForecastConfig(model_type="ensemble", horizon=3, ensemble_is_arima=True)).collect()}
    assert alias == {k: r.forecast for k, r in a.items()}


@pytest.mark.parametrize("kind", ["arima", "ets"])
def test_folds_equal_models_of_the_earlier_points_alone(spark, prepared, values, kind):
    cfg = ForecastConfig(model_type=kind, seasonal_order=(0, 0, 0), horizon=1)
    some = prepared.where("series_id in ('season', 'short')")
    folds = {(r.series_id, r.pos): r for r in forecast.backtest_folds(some, cfg, 6, 2).collect()}
    assert sorted(folds) == [("season", 90), ("season", 92), ("season", 94), ("short", 14), ("short", 16), ("short", 18)]
    for k, pos in [("season", 92), ("short", 16)]:
        rows = [(k, DAY + datetime.timedelta(days=i), v) for i, v in enumerate(values[k][:pos])]
        alone = forecast.forecast(series.prepare(spark.createDataFrame(rows, "series_id string, date date, value double")), cfg).first()
        r = folds[k, pos]
        assert np.allclose([r.predicted, r.lower, r.upper], [alone.forecast, alone.lower, alone.upper]) and r.actual == values[k][pos]
    metrics = {r.series_id: r for r in forecast.backtest(some, cfg, 6, 2).collect()}
    errors = [r.actual - r.predicted for (k, _), r in folds.items() if k == "season"]
    assert metrics["season"].folds == 3 and np.isclose(metrics["season"].rmse, np.sqrt(np.mean(np.square(errors))))


def test_diagnostics(prepared, values):
    rows = {r.series_id: r for r in forecast.model_diagnostics(prepared, PLAIN).collect()}
    assert set(rows) == {k for k, v in values.items() if len(v) >= 12}
    assert (rows["constant"].model, rows["constant"].observations, rows["constant"].terms) == ("simple", 40, None)
    model = forecast.arima_models(prepared.where("series_id = 'level'"), PLAIN).first()
    r, e = rows["level"], np.array(model.errors)
    likelihood = -len(e) / 2 * (np.log(2 * np.pi * np.mean(e**2)) + 1)
    free = model.p + model.q + 2
    assert r.model == "arima" and np.isclose(r.log_likelihood, likelihood) and np.isclose(r.aic, 2 * free - 2 * likelihood)
    assert np.isclose(r.bic, free * np.log(len(e)) - 2 * likelihood) and np.isclose(r.residual_mean, e.mean()) and np.isclose(r.residual_std, e.std(ddof=1))
    assert set(r.terms) == {"const", *[f"ar.L{k}" for k in range(1, model.p + 1)], *[f"ma.L{k}" for k in range(1, model.q + 1)]}
    assert 0 <= r.ljung_box_pvalue <= 1


def test_empty_input(spark, prepared):
    none = prepared.where("false")
    for kind in ("arima", "ets", "ensemble"):
        assert forecast.forecast(none, ForecastConfig(model_type=kind)).count() == 0
    assert forecast.backtest(none).count() == forecast.model_diagnostics(none).count() == arima.adf(none).count() == 0


def test_settings_are_checked():
    for bad in ({"seasonal_order": (2, 1, 1)}, {"arima_order": (3, 1, 1)}, {"arima_order": (1, 2, 1)}, {"seasonal_period": 1}):
        with pytest.raises(ValueError):
            ForecastConfig(**bad)
