"""Stationarity test, order search, two-stage ARIMA fit, forecasts with intervals and diagnostics for many series.

All least squares go through sums of products. Per series (or per training part of a series) one matrix G holds the sums of the products
of 1, w_t, w_(t-1), ... of the differenced values w. The long autoregression is solved from G; its residuals are fixed combinations
of the same terms, so the sums of products of all terms of every ARMA order are T G T', without another pass over the rows.
Sums add up: the matrix of a longer training part is that of a shorter one plus the rows between.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.functions.linear import cholesky, congruent, dot, gram, gram_cells, let, picked, solved, total, vector

KEYS = ("series_id",)
# Order of the long autoregression whose residuals stand in for the errors.
LONG = 8
MOST = 2
# Published response surface of the unit-root test with a constant (MacKinnon), polynomial in tau of the normal quantile.
TAU_SURFACE = (2.1659, 1.4412, 0.038269)


def critical_tau(significance: float = 0.05) -> float:
    """The tau below which the unit-root hypothesis is rejected."""
    c, b, a = TAU_SURFACE[0] - NormalDist().inv_cdf(significance), TAU_SURFACE[1], TAU_SURFACE[2]
    return (-b + math.sqrt(b * b - 4 * a * c)) / (2 * a)


def listed(prepared: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys, ys: the values in order. A series has a value per period, so the calendar bounds the array."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return prepared.groupBy(*keys).agg(rows.alias("_r")).select(*keys, F.col("_r.value").alias("ys"))


def _backwards(values: Column, before: Column, count: Column | int) -> Column:
    """`count` values in front of place `before`, the nearest first."""
    n = F.lit(count) if isinstance(count, int) else count
    return F.reverse(F.slice(values, before - n + 1, n))


def _places(first: Column, last: Column) -> Column:
    """first..last; empty if there are none (a plain sequence would run backwards)."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


# --- stationarity


def adf(prepared: DataFrame, keys: Sequence[str] = KEYS, significance: float = 0.05) -> DataFrame:
    """keys, lags, tau, stationary, d: augmented Dickey-Fuller test with a constant, lags by least AIC on the common sample.

    One factorisation of the largest regression leaves the residual sums of all numbers of lags; the chosen one is solved again on all rows
    it can use. A series without variation has no tau and d = 1.
    """
    keys = list(keys)
    n = F.size("ys")
    most = F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))).cast("int"), F.floor(n / 2).cast("int") - 2)
    rows = listed(prepared, keys).withColumn("mid", total(F.col("ys")) / n)
    rows = rows.select(*keys, F.transform("ys", lambda y: y - F.col("mid")).alias("ys"), most.alias("most")).where(F.col("most") >= 0)
    rows = rows.withColumn("dy", F.transform(F.sequence(F.lit(1), F.size("ys") - 1), lambda t: F.get("ys", t) - F.get("ys", t - 1)))

    def sample(lags: str, level_first: bool) -> Column:
        def terms(t: Column) -> Column:
            back, level = _backwards(F.col("dy"), t, F.col(lags)), F.array(F.get("ys", t))
            return F.concat(vector(1), *((level, back) if level_first else (back, level)), F.array(F.get("dy", t)))

        return F.explode(F.transform(_places(F.col(lags), F.size("dy") - 1), terms))

    def solved_rows(source: DataFrame, lags: str, level_first: bool) -> DataFrame:
        cells = gram_cells(source.select(*keys, sample(lags, level_first).alias("terms")), keys)
        return gram(cells, keys).select(
            *keys, "size", F.element_at(F.element_at("gram", 1), 1).alias("rows"), F.element_at(let(F.col("gram"), lambda m: cholesky(m, F.col("size"))), -1).alias("last")
        )

    wide = solved_rows(rows, "most", True)
    # Terms: 1, level, lags..., response. What a model with k lags leaves is the share of the lags behind it and of the response.
    k_most = F.col("size") - 3

    def aic(k: Column) -> Column:
        left = F.slice("last", k + 3, F.col("size") - 2 - k)
        return F.col("rows") * F.log(dot(left, left) / F.col("rows")) + 2 * (k + 2)

    choices = F.filter(F.transform(F.sequence(F.lit(0), k_most), lambda k: F.struct(aic(k).alias("aic"), k.alias("lags"))), lambda c: c["aic"].isNotNull())
    chosen = wide.select(*keys, F.array_min(choices)["lags"].alias("lags"))
    final = solved_rows(rows.join(chosen.where(F.col("lags").isNotNull()), keys), "lags", False)
    share, left = F.element_at("last", -2), F.element_at("last", -1)
    tau = F.try_divide(share, left) * F.sqrt(F.col("rows") - (F.col("size") - 1))
    tested = final.select(*keys, (F.col("size") - 3).alias("lags"), tau.alias("tau"))
    below = F.coalesce(F.col("tau") < critical_tau(significance), F.lit(False))
    return prepared.select(*keys).distinct().join(tested, keys, "left").select(*keys, "lags", "tau", below.alias("stationary"), F.when(below, 0).otherwise(1).alias("d"))


# --- fit


def _lag_sets(season: int, long: int) -> tuple[list[int], list[int]]:
    """Lags of the long autoregression; lags that AR and MA terms may have."""
    extra = [season] if season else []
    return [*[k for k in range(1, long + 1) if k != season], *extra], [*range(1, MOST + 1), *extra]


def differenced(series: DataFrame, season: int = 0) -> DataFrame:
    """series (keys, ys, d) with back (y_t = w_t + back . earlier y), w less its mean, and that mean `mid`."""
    spans = [[1.0], [0.0] * (season - 1) + [1.0], [1.0] + [0.0] * (season - 2) + [1.0, -1.0]] if season else [[1.0]]
    back = F.when(F.col("d") == 1, vector(*spans[2 if season else 0])).otherwise(vector(*spans[1]) if season else F.array().cast("array<double>"))
    rows = series.withColumn("back", back).where(F.size("ys") > F.size("back"))
    w = F.transform(F.sequence(F.size("back"), F.size("ys") - 1), lambda t: F.get("ys", t) - dot(F.col("back"), _backwards(F.col("ys"), t, F.size("back"))))
    rows = rows.withColumn("w", w).withColumn("mid", total(F.col("w")) / F.size("w"))
    return rows.withColumn("w", F.transform("w", lambda x: x - F.col("mid")))


def _moments(rows: DataFrame, keys: list[str], season: int, long: int) -> DataFrame:
    """keys, gram, size: sums of products of 1, w_t, w_(t-1), ... as far back as the second stage asks."""
    long_lags, lags = _lag_sets(season, long)
    depth = max(long_lags) + max(lags)
    terms = F.transform(_places(F.lit(depth), F.size("w") - 1), lambda t: F.concat(vector(1), _backwards(F.col("w"), t + 1, depth + 1)))
    return gram(gram_cells(rows.select(*keys, F.explode(terms).alias("terms")), keys), keys)


def _second_stage(season: int, long: int) -> Column:
    """From `gram`: sums of products of 1, lags of w, lags of the long autoregression's residuals, and w."""
    long_lags, lags = _lag_sets(season, long)
    width = max(long_lags) + max(lags) + 2
    places = F.array(*map(F.lit, [0, *[1 + k for k in long_lags], 1]))

    def unit(at: int) -> Column:
        return vector(*[float(i == at) for i in range(width)])

    def residual(a: Column, k: int) -> Column:
        shifted = {0: 0, **{1 + k + lag: i for i, lag in enumerate(long_lags, 1)}}
        return F.array(*[F.lit(1.0) if i == 1 + k else -F.get(a, F.lit(shifted[i])) if i in shifted else F.lit(0.0) for i in range(width)])

    def moments(a: Column) -> Column:
        t = F.array(unit(0), *[unit(1 + k) for k in lags], *[residual(a, k) for k in lags], unit(1))
        return congruent(F.col("gram"), t)

    long_fit = let(picked(F.col("gram"), places), lambda m: let(cholesky(m, F.lit(len(long_lags) + 2)), lambda f: solved(f, F.lit(len(long_lags) + 1))))
    return let(long_fit, moments)


def _order(p: int, q: int, season: int) -> Column:
    """p, q and where the terms of this order stand in the second stage's matrix."""
    width = MOST + bool(season)
    extra = [MOST + 1] if season else []
    places = [0, *range(1, p + 1), *extra, *[width + k for k in range(1, q + 1)], *[width + k for k in extra], 2 * width + 1]
    return F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.array(*map(F.lit, places)).alias("places"))


def orders(series: DataFrame, keys: Sequence[str] = KEYS, season: int = 0, pairs: Sequence[tuple[int, int]] | None = None, long: int = LONG) -> DataFrame:
    """keys, rows, p, q, aic, coefficients, fits: every asked order of every series (keys, ys, d) whose sums can be solved.

    coefficients: constant, AR terms by lag, MA terms by lag; with a season one more AR and MA term at that lag. An order fits if the
    magnitudes of its MA terms add up to less than 1, which keeps the residuals from growing.
    """
    keys = list(keys)
    pairs = list(pairs or product(range(MOST + 1), repeat=2))
    seasonal = int(bool(season))
    second = _moments(differenced(series, season), keys, season, long).withColumn("second", _second_stage(season, long))
    rows = second.select(*keys, F.element_at(F.element_at("gram", 1), 1).alias("rows"), "second", F.inline(F.array(*[_order(p, q, season) for p, q in pairs])))
    rows = rows.withColumn("factor", let(picked(F.col("second"), F.col("places")), lambda m: cholesky(m, F.size("places"))))
    left = F.element_at(F.element_at("factor", -1), -1)
    rows = rows.withColumn("coefficients", let(F.col("factor"), lambda f: solved(f, F.size("places") - 1)))
    terms = F.size("places") - 1
    rows = rows.withColumn("aic", F.col("rows") * F.log(left * left / F.col("rows")) + 2 * (terms + 1)).where(F.col("aic").isNotNull() & (F.col("rows") > terms + 1))
    ma = F.slice("coefficients", F.col("p") + 2 + seasonal, F.col("q") + seasonal)
    fits = total(F.transform(ma, F.abs)) < 1
    return rows.select(*keys, "rows", "p", "q", "aic", "coefficients", fits.alias("fits"))


def chosen(tried: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The fitting order of least AIC, ties to the smaller p, then q."""
    best = tried.where("fits").groupBy(*keys).agg(F.min_by(F.struct("p", "q", "aic", "coefficients"), F.struct("aic", "p", "q")).alias("b"))
    return best.select(*keys, "b.*")


def fitted(
    prepared: DataFrame, differences: DataFrame | int, keys: Sequence[str] = KEYS, season: int = 0, pairs: Sequence[tuple[int, int]] | None = None, long: int = LONG
) -> DataFrame:
    """One row per series that can be solved: keys, d, p, q, aic, constant, phi and theta by lag, ys, w, mid, back, errors, sse.

    differences: d for all, or keys and d. The errors follow from the fitted terms in order, from the longest lag on.
    Series without any fitting order (too short, without variation) have no row.
    """
    keys = list(keys)
    series = listed(prepared, keys)
    series = series.withColumn("d", F.lit(differences)) if isinstance(differences, int) else series.join(differences.select(*keys, "d"), keys)
    model = chosen(orders(series, keys, season, pairs, long), keys)
    rows = differenced(series, season).join(model, keys)
    seasonal, span = int(bool(season)), max(season, MOST)

    def dense(first: Column, count: Column) -> Column:
        def at(k: Column) -> Column:
            plain = F.when(k <= count, F.get("coefficients", first + k - 1))
            return F.coalesce(plain.when(k == season, F.get("coefficients", first + count)) if season else plain, F.lit(0.0))

        return F.transform(F.sequence(F.lit(1), F.lit(span)), at)

    rows = rows.select(
        *keys, "d", "p", "q", "aic", F.get("coefficients", F.lit(0)).alias("constant"),
        dense(F.lit(1), F.col("p")).alias("phi"), dense(F.col("p") + 1 + seasonal, F.col("q")).alias("theta"), "ys", "w", "mid", "back",
    )
    known = F.transform(
        F.sequence(F.lit(span), F.size("w") - 1), lambda t: F.get("w", t) - F.col("constant") - dot(F.col("phi"), _backwards(F.col("w"), t, span))
    )
    rows = rows.withColumn("known", known)
    # Errors before the longest lag count as zero; they are taken off again.
    errors = F.aggregate("known", F.array_repeat(F.lit(0.0), span), lambda e, x: F.concat(e, F.array(x - dot(F.col("theta"), _backwards(e, F.size(e), span)))))
    rows = rows.withColumn("errors", F.slice(errors, span + 1, F.size("known"))).drop("known")
    return rows.withColumn("sse", dot(F.col("errors"), F.col("errors")))


# --- forecast


def _pushed(tail: Column, value: Column) -> Column:
    """The nearest-first tail with a new nearest value."""
    return F.slice(F.concat(F.array(value), tail), F.lit(1), F.size(tail))


def _simulated(constant: Column, mid: Column, w: Column, e: Column, y: Column, shocks: Column) -> Column:
    """Values of y from nearest-first tails of w, e, y, one per shock."""

    def merge(s: Column, shock: Column) -> Column:
        value = constant + dot(F.col("phi"), s["w"]) + dot(F.col("theta"), s["e"]) + shock

        def level(new: Column) -> Column:
            return let(
                new + mid + dot(F.col("back"), s["y"]),
                lambda v: F.struct(
                    _pushed(s["w"], new).alias("w"), _pushed(s["e"], shock).alias("e"), _pushed(s["y"], v).alias("y"), F.concat(s["out"], F.array(v)).alias("out")
                ),
            )

        return let(value, level)

    start = F.struct(w.alias("w"), e.alias("e"), y.alias("y"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(shocks, start, merge)["out"]


def _zeros(n: Column | int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def ahead(models: DataFrame, horizon: int) -> DataFrame:
    """models with `forecast` and its standard errors `se`, both as arrays over the steps.

    What an error of one period does to the later ones is the response of the same recursion to a single shock; the squared responses up
    to a step, summed, times the error variance are the variance of that step.
    """
    span = F.size("phi")
    padded = F.concat(_zeros(span), F.col("errors"))
    forecast = _simulated(
        F.col("constant"), F.col("mid"), _backwards(F.col("w"), F.size("w"), span), _backwards(padded, F.size(padded), span),
        _backwards(F.col("ys"), F.size("ys"), F.size("back")), _zeros(horizon),
    )
    impulse = vector(1.0, *[0.0] * (horizon - 1))
    response = _simulated(F.lit(0.0), F.lit(0.0), _zeros(span), _zeros(span), _zeros(F.size("back")), impulse)
    rows = models.withColumn("forecast", forecast).withColumn("response", response)
    variance = F.col("sse") / F.size("errors")
    spread = F.transform("response", lambda _, i: F.sqrt(variance * let(F.slice("response", F.lit(1), i + 1), lambda r: dot(r, r))))
    return rows.withColumn("se", spread).drop("response")


def coefficients(models: DataFrame, keys: Sequence[str] = KEYS, season: int = 0) -> DataFrame:
    """keys, d, p, q, terms: a map from the name of each term of the model to its value."""
    span = F.sequence(F.lit(1), F.size("phi"))
    used = {"ar": F.col("p"), "ma": F.col("q")}

    def named(kind: str, values: str) -> Column:
        pairs = F.transform(span, lambda k: F.struct(F.concat(F.lit(f"{kind}.L"), k.cast("string")), F.get(values, k - 1)))
        return F.filter(pairs, lambda s: F.substring(s["col1"], 5, 9).cast("int").isin(season) | (F.substring(s["col1"], 5, 9).cast("int") <= used[kind]))

    constant = F.array(F.struct(F.lit("const").alias("col1"), F.col("constant").alias("col2")))
    return models.select(*keys, "d", "p", "q", F.map_from_entries(F.concat(constant, named("ar", "phi"), named("ma", "theta"))).alias("terms"))


def residual_rows(models: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys, date (the place of the error), value: the errors of the fitted models as rows."""
    return models.select(*keys, F.posexplode("errors").alias("date", "value"))


def diagnostics(models: DataFrame, keys: Sequence[str] = KEYS, season: int = 0) -> DataFrame:
    """keys, observations, log_likelihood, aic, bic, residual_mean, residual_std: Gaussian likelihood at the fitted terms."""
    m = F.size("errors")
    free = F.col("p") + F.col("q") + 2 + 2 * bool(season)
    likelihood = -m / 2 * (F.log(2 * math.pi * F.col("sse") / m) + 1)
    rows = models.select(*keys, F.size("ys").cast("bigint").alias("observations"), likelihood.alias("log_likelihood"), m.alias("m"), free.alias("free"), (total(F.col("errors")) / m).alias("residual_mean"), "sse")
    spread = F.sqrt((F.col("sse") - F.col("m") * F.col("residual_mean") * F.col("residual_mean")) / (F.col("m") - 1))
    return rows.select(
        *keys, "observations", "log_likelihood", (2 * F.col("free") - 2 * F.col("log_likelihood")).alias("aic"),
        (F.col("free") * F.log("m") - 2 * F.col("log_likelihood")).alias("bic"), "residual_mean", spread.alias("residual_std"),
    )


def expanding(prepared: DataFrame, test_size: int = 12, step_size: int = 1, least: int = 12) -> DataFrame:
    """Training parts of a rolling origin: series_id, cut, pos, value, n, one part per predicted place `cut`, rows before it."""
    cuts = F.filter(F.sequence(F.lit(test_size), F.lit(1), F.lit(-step_size)), lambda back: F.col("n") - back >= least)
    rows = prepared.select("series_id", "pos", "value", F.explode(F.transform(cuts, lambda back: (F.col("n") - back).cast("int"))).alias("cut"))
    return rows.where(F.col("pos") < F.col("cut")).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("series_id", "cut")))
