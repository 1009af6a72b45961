"""Additive Holt-Winters for many series: level, trend and season, weights chosen on a grid that is refined around the best.

One step of the recursion is an affine map of the state (level, trend, one term per phase). Steps compose, so a series is cut into chunks:
every chunk is run from a zero state, the state at each chunk's start follows from these results and one small matrix per choice of
weights, and then all chunks run side by side from their true states. A chunk has a fixed length, so no task holds a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.linear import added, combined, let
from basketflow.session import stored

CHUNK = 64
GRID = (0.1, 0.3, 0.5, 0.7, 0.9)
# Distance of the neighbours that each further round asks around the best weights.
ROUNDS = (0.1, 0.05)
WEIGHTS = ["alpha", "beta", "gamma"]


def _step(x: Column, y: Column, period: int) -> tuple[Column, Column]:
    error = y - F.get(x, F.lit(0)) - F.get(x, F.lit(1)) - F.get(x, F.lit(2))

    def moved(e: Column) -> Column:
        level = F.get(x, F.lit(0)) + F.get(x, F.lit(1)) + F.col("alpha") * e
        trend = F.get(x, F.lit(1)) + F.col("alpha") * F.col("beta") * e
        return F.concat(F.array(level, trend), F.slice(x, 4, period - 1), F.array(F.get(x, F.lit(2)) + F.col("gamma") * e))

    return error, moved


def _run(ys: Column, start: Column, period: int) -> Column:
    """struct(x, sse): the state after the values ys and the sum of squared one-step errors."""

    def merge(state: Column, y: Column) -> Column:
        error, moved = _step(state["x"], y, period)
        return let(error, lambda e: F.struct(moved(e).alias("x"), (state["sse"] + e * e).alias("sse")))

    return F.aggregate(ys, F.struct(start.alias("x"), F.lit(0.0).alias("sse")), merge)


def starts(prepared: DataFrame, keys: Sequence[str], period: int = 12) -> DataFrame:
    """keys, n, start: level is the mean of the first season, trend its mean change to the second, the season what is left of the first.

    Series shorter than two seasons have none.
    """
    first, second = F.col("pos") < period, F.col("pos").between(period, 2 * period - 1)
    rows = prepared.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.avg(F.when(first, F.col("value"))).alias("level"),
        F.avg(F.when(second, F.col("value"))).alias("next"),
        F.array_sort(F.collect_list(F.when(first, F.struct("pos", "value")))).alias("season"),
    )
    season = F.transform("season", lambda s: s["value"] - F.col("level"))
    start = F.concat(F.array("level", (F.col("next") - F.col("level")) / period), season)
    return rows.where(F.col("n") >= 2 * period).select(*keys, "n", start.alias("start"))


def chunks(prepared: DataFrame, keys: Sequence[str], period: int = 12, length: int = CHUNK) -> DataFrame:
    """keys, chunk, ys: the values behind the first season, so many in a row."""
    rows = prepared.where(F.col("pos") >= period).withColumn("chunk", F.floor((F.col("pos") - period) / length))
    listed = rows.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("r"))
    return listed.select(*keys, "chunk", F.col("r.value").alias("ys"))


def runs(parts: DataFrame, weighted: DataFrame, keys: Sequence[str], period: int = 12, length: int = CHUNK) -> DataFrame:
    """weighted (keys, n, start, alpha, beta, gamma) with the sum of squared errors and the last state of each run."""
    by = [*keys, *WEIGHTS]
    width = period + 2
    zero = F.array_repeat(F.lit(0.0), width)
    unit = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (i == k).cast("double")))
    # What a full chunk makes of the state at its start, apart from its values: one column per entry of the state.
    matrices = weighted.select(*WEIGHTS).distinct().withColumn("move", F.transform(unit, lambda u: _run(F.array_repeat(F.lit(0.0), length), u, period)["x"]))
    rows = parts.join(weighted, list(keys))
    alone = rows.select(*by, "chunk", "start", _run(F.col("ys"), zero, period)["x"].alias("own"))
    listed = alone.groupBy(*by).agg(F.first("start").alias("start"), F.array_sort(F.collect_list(F.struct("chunk", "own"))).alias("r"))

    def entered(states: Column, own: Column) -> Column:
        return F.concat(states, F.array(added(combined(F.col("move"), F.element_at(states, -1)), own)))

    entries = F.aggregate(F.slice(F.col("r.own"), 1, F.size("r") - 1), F.array("start"), entered)
    entry = listed.join(matrices, WEIGHTS).select(*by, F.posexplode(entries).alias("chunk", "entry"))
    ends = rows.join(entry, [*by, "chunk"]).withColumn("end", _run(F.col("ys"), F.col("entry"), period))
    return ends.groupBy(*by).agg(F.first("n").alias("n"), F.sum("end.sse").alias("sse"), F.max_by("end.x", "chunk").alias("state"))


def _allowed() -> Column:
    one = [(F.col(w) > 0) & (F.col(w) < 1) for w in WEIGHTS]
    return one[0] & one[1] & one[2] & (F.round(F.col("alpha") + F.col("gamma"), 6) <= 1)


def _best(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    order = F.struct("sse", *WEIGHTS)
    chosen = results.where(F.col("sse").isNotNull() & ~F.isnan("sse")).groupBy(*keys).agg(F.min_by(F.struct("n", *WEIGHTS, "sse", "state"), order).alias("b"))
    return chosen.select(*keys, "b.*")


def with_weights(start: DataFrame, weights: Sequence[tuple[float, float, float]]) -> DataFrame:
    """A row of each series for every choice of weights."""
    listed = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for v, n in zip(w, WEIGHTS)]) for w in weights])
    return start.select("*", F.inline(listed))


def fitted(
    prepared: DataFrame, keys: Sequence[str] = ("series_id",), period: int = 12, grid: Sequence[float] = GRID, rounds: Sequence[float] = ROUNDS, length: int = CHUNK
) -> DataFrame:
    """keys, n, alpha, beta, gamma, sse, state: of the grid, then of the neighbours of the best, the weights of least squared one-step error.

    Ties go to the smallest weights. Series shorter than two seasons are left out. A series' rows meet in chunks, never as a whole.
    """
    start, parts = stored(starts(prepared, keys, period), "season-starts"), stored(chunks(prepared, keys, period, length), "season-chunks")
    tried = with_weights(start, list(product(grid, repeat=3))).where(_allowed())
    best = stored(_best(runs(parts, tried, keys, period, length), keys), "season-weights")
    for step in rounds:
        moves = F.array(*[F.struct(*[F.lit(float(v) * step).alias(f"d{n}") for v, n in zip(m, WEIGHTS)]) for m in product((-1, 0, 1), repeat=3)])
        near = best.select(*keys, *WEIGHTS, F.inline(moves)).select(*keys, *[F.round(F.col(w) + F.col(f"d{w}"), 6).alias(w) for w in WEIGHTS]).where(_allowed())
        best = stored(_best(runs(parts, start.join(near, list(keys)), keys, period, length), keys), "season-weights")
    return best


def fixed(prepared: DataFrame, alpha: float, beta: float, gamma: float, keys: Sequence[str] = ("series_id",), period: int = 12, length: int = CHUNK) -> DataFrame:
    """As `fitted`, at given weights."""
    weighted = with_weights(starts(prepared, keys, period), [(alpha, beta, gamma)])
    return runs(chunks(prepared, keys, period, length), weighted, keys, period, length)


def ahead(models: DataFrame, step: Column, period: int = 12) -> tuple[Column, Column]:
    """Forecast `step` periods after the last value, and its standard error from the squared weights of the errors before it."""
    level, trend = F.get("state", F.lit(0)), F.get("state", F.lit(1))
    season = F.get("state", ((step - 1) % period + 2).cast("int"))
    before = F.filter(F.sequence(F.lit(0), step.cast("int")), lambda j: (j > 0) & (j < step))
    weight = F.transform(before, lambda j: F.pow(F.col("alpha") * (1 + F.col("beta") * j) + F.when(j % period == 0, F.col("gamma")).otherwise(0.0), F.lit(2.0)))
    spread = F.aggregate(weight, F.lit(1.0), lambda a, x: a + x)
    return level + trend * step + season, F.sqrt(F.col("sse") / (F.col("n") - period) * spread)
