"""Price index: base prices, category indices, overall index, rates and intervals.

Sums of logs add up, so the facts are reduced once to (day, slot, category) statistics and
every window of every as-of instant is a sum over those few rows. The slot places a time of
day before, at or after the as-of time of day, which keeps both window edges exact.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketflow.config import IndexConfig
from basketflow.functions.numeric import nan_to_null, pct_change, t_quantile
from basketflow.functions.timeparts import date_range, ts_like
from basketflow.session import BROADCAST_ROWS, materialize

SPANS = ("cur", "mom", "yoy")
KEYS = ["category", "product_id"]


def base_prices(panel: DataFrame, cfg: IndexConfig) -> DataFrame:
    """Mean price per product and category in the base period.

    With nothing in the period, a period of the same length from the earliest row stands in, with all of its
    rows; the probe stops at the first hit.
    """
    ts = F.col("timestamp")
    start = ts_like(panel, "timestamp", cfg.base_period)
    end = ts_like(panel, "timestamp", cfg.base_period + timedelta(days=cfg.base_days))
    rows = panel.where((ts >= start) & (ts < end))
    if rows.isEmpty():
        earliest = panel.agg(F.min("timestamp")).first()[0]
        rows = panel.where((ts >= F.lit(earliest)) & (ts < F.lit(earliest) + F.make_dt_interval(F.lit(cfg.base_days))))
    return rows.groupBy(*KEYS).agg(F.avg(nan_to_null(F.col("price"))).alias("base_price"))


def _day_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.date_trunc("DAY", ts), ts)


def _slot(ts: Column, phases: tuple[int, ...]) -> Column:
    """Odd = exactly at an as-of time of day, even = between two of them."""
    micros = _day_micros(ts)
    steps = [(micros >= p).cast("int") + (micros > p).cast("int") for p in phases]
    return reduce(lambda a, b: a + b, steps)


def _phases(as_ofs: list[datetime]) -> tuple[int, ...]:
    midnight = timedelta(microseconds=1)
    return tuple(
        sorted({timedelta(hours=t.hour, minutes=t.minute, seconds=t.second, microseconds=t.microsecond) // midnight for t in as_ofs})
    )


def day_statistics(panel: DataFrame, base: DataFrame, phases: tuple[int, ...] = (0,)) -> DataFrame:
    """(day, slot, category) -> rows, matched rows, sum of log price relatives."""
    return _statistics(panel.withColumns({"day": F.to_date("timestamp"), "slot": _slot(F.col("timestamp"), phases)}), base, ["day", "slot"])


def _statistics(panel: DataFrame, base: DataFrame, by: list[str]) -> DataFrame:
    """(by, category) -> rows, matched rows, sum of log price relatives."""
    price = nan_to_null(F.col("price"))
    obs = panel.select(*by, *KEYS, F.when(price > 0, F.ln(price)).alias("ln_price"))
    side, rows = materialize(base.where("base_price > 0").select(*KEYS, F.ln("base_price").alias("ln_base")))
    n_rel = F.count(F.col("ln_price") + F.col("ln_base"))
    if rows <= BROADCAST_ROWS:
        relative = F.col("ln_price") - F.col("ln_base")
        return (
            obs.join(F.broadcast(side), KEYS, "left")
            .groupBy(*by, "category")
            .agg(F.count(F.lit(1)).alias("n_obs"), n_rel.alias("n_rel"), F.sum(relative).alias("ln_sum"))
        )
    # Many products: first one row per product and place in time, so that no product is hot in the join.
    per_product = obs.groupBy(*by, *KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count("ln_price").alias("n_price"), F.sum("ln_price").alias("ln_sum")
    )
    matched = F.col("ln_base").isNotNull()
    return (
        per_product.join(side, KEYS, "left")
        .groupBy(*by, "category")
        .agg(
            F.sum("n").alias("n_obs"),
            F.coalesce(F.sum(F.when(matched, F.col("n_price"))), F.lit(0)).alias("n_rel"),
            F.sum(F.col("ln_sum") - F.col("n_price") * F.col("ln_base")).alias("ln_sum"),
        )
    )


def _span_days(as_ofs: DataFrame, cfg: IndexConfig, phases: tuple[int, ...]) -> DataFrame:
    """As-of rows to one row per span and calendar day the window touches."""
    shifts = F.array(
        *[F.struct(F.lit(s).alias("span"), F.lit(d).alias("shift")) for s, d in zip(SPANS, (0, cfg.month_days, cfg.year_days))]
    )
    return (
        as_ofs.select("as_of", _slot(F.col("as_of"), phases).alias("edge"), F.inline(shifts))
        .withColumn("hi", F.date_sub(F.to_date("as_of"), F.col("shift")))
        .withColumn("lo", F.date_sub("hi", cfg.window_days))
        .withColumn("day", F.explode(F.sequence("lo", "hi")))
    )


def window_statistics(stats: DataFrame, as_ofs: DataFrame, cfg: IndexConfig, phases: tuple[int, ...] = (0,)) -> DataFrame:
    """(as_of, span, category) sums over the closed windows [as_of - shift - days, as_of - shift]."""
    inside = ((F.col("day") > F.col("lo")) | (F.col("slot") >= F.col("edge"))) & (
        (F.col("day") < F.col("hi")) | (F.col("slot") <= F.col("edge"))
    )
    return (
        _span_days(as_ofs, cfg, phases)
        .join(stats, "day")
        .where(inside)
        .groupBy("as_of", "span", "category")
        .agg(F.sum("n_obs").alias("n_obs"), F.sum("n_rel").alias("n_rel"), F.sum("ln_sum").alias("ln_sum"))
    )


def category_index(n_rel: Column, ln_sum: Column, min_observations: int) -> Column:
    """Geometric mean of the price relatives; 100 for a thin or empty category."""
    return F.when(n_rel >= min_observations, F.exp(ln_sum / n_rel) * 100).otherwise(F.lit(100.0))


def _total(indices: dict[str, Column], cfg: IndexConfig, weighted: bool) -> Column:
    terms = [indices[c] * w for c, w in cfg.weights.items()] if weighted else list(indices.values())
    total = reduce(lambda a, b: a + b, terms)
    return total if weighted else total / len(terms)


def confidence_interval(values: list[Column], confidence: float) -> tuple[Column, Column]:
    """Student interval of the mean of the category indices; (0, 0) below two values."""
    n = len(values)
    if n < 2:
        return F.lit(0.0), F.lit(0.0)
    mean = reduce(lambda a, b: a + b, values) / n
    spread = F.sqrt(reduce(lambda a, b: a + b, [F.pow(v - mean, F.lit(2.0)) for v in values]) / (n - 1) / n)
    half = spread * t_quantile(confidence, n - 1)
    return mean - half, mean + half


def price_index(stats: DataFrame, as_ofs: DataFrame, cfg: IndexConfig, phases: tuple[int, ...] = (0,)) -> DataFrame:
    """One result row per as-of instant, whether or not its windows hold rows."""
    return index_of_windows(window_statistics(stats, as_ofs, cfg, phases), as_ofs, cfg)


def index_of_windows(windows: DataFrame, as_ofs: DataFrame, cfg: IndexConfig) -> DataFrame:
    """Result rows of the as-of instants from the sums (as_of, span, category) of their windows."""
    windows = windows.withColumn("idx", category_index(F.col("n_rel"), F.col("ln_sum"), cfg.min_observations))
    in_span = {s: F.col("span") == s for s in SPANS}
    cats = list(cfg.weights)
    wide = windows.groupBy("as_of").agg(
        *[F.sum(F.when(in_span[s], F.col("n_obs"))).alias(f"n_{s}") for s in SPANS],
        *[
            F.max(F.when(in_span[s] & (F.col("category") == c), F.col("idx"))).alias(f"{s}_{i}")
            for s in SPANS
            for i, c in enumerate(cats)
        ],
    )
    idx = {s: {c: F.coalesce(F.col(f"{s}_{i}"), F.lit(100.0)) for i, c in enumerate(cats)} for s in SPANS}
    lag_weighted = cfg.use_weights if cfg.consistent_lags else True
    totals = {s: _total(idx[s], cfg, cfg.use_weights if s == "cur" else lag_weighted) for s in SPANS}
    lower, upper = confidence_interval(list(idx["cur"].values()), cfg.confidence_level)
    has = {s: F.coalesce(F.col(f"n_{s}"), F.lit(0)) > 0 for s in SPANS}

    def rate(span: str) -> Column:
        return F.when(has["cur"] & has[span] & (totals[span] > 0), pct_change(totals["cur"], totals[span])).otherwise(0.0)

    def as_map(values: dict[str, Column]) -> Column:
        full = F.create_map(*chain.from_iterable((F.lit(c), v) for c, v in values.items()))
        return F.when(has["cur"], full).otherwise(F.map_from_entries(F.expr("CAST(array() AS ARRAY<STRUCT<k: STRING, v: DOUBLE>>)")))

    current = F.when(has["cur"], totals["cur"]).otherwise(100.0)
    return as_ofs.join(wide, "as_of", "left").select(
        "as_of",
        F.coalesce("n_cur", F.lit(0)).cast("bigint").alias("observation_count"),
        current.alias("price_index"),
        (current - 100).alias("inflation_rate"),
        rate("mom").alias("inflation_mom"),
        rate("yoy").alias("inflation_yoy"),
        F.when(has["cur"], lower).otherwise(0.0).alias("ci_lower"),
        F.when(has["cur"], upper).otherwise(0.0).alias("ci_upper"),
        as_map(idx["cur"]).alias("category_indices"),
        as_map({c: (v - 100) * cfg.weights[c] for c, v in idx["cur"].items()}).alias("category_contributions"),
        (has["cur"] & F.lit(cfg.seasonal_adjustment)).alias("is_seasonally_adjusted"),
    )


# Time ranges that a scan filter names, at most; the nearest ones are joined until there are no more.
MOST_RANGES = 64
MINUTE = 60_000_000
SUMS = ["n_obs", "n_rel", "ln_sum"]


def _windows(axis: DataFrame, cfg: IndexConfig) -> DataFrame:
    """as_of, span, hi_day, hi, lo_day, lo: both ends of the three windows of every instant, as a day and microseconds of the day."""
    spans = zip(SPANS, (0, cfg.month_days, cfg.year_days))
    shifts = F.array(*[F.struct(F.lit(s).alias("span"), F.lit(d).alias("shift")) for s, d in spans])
    rows = axis.select("as_of", _day_micros(F.col("as_of")).alias("hi"), F.inline(shifts)).withColumn("hi_day", F.date_sub(F.to_date("as_of"), F.col("shift")))
    return rows.select("as_of", "span", "hi_day", "hi", F.date_sub("hi_day", cfg.window_days).alias("lo_day"), F.col("hi").alias("lo"))


def _day_filter(panel: DataFrame, windows: DataFrame) -> Column:
    """What the scan has to read: the days of the windows as ranges. The calendar bounds the days that come to the driver."""
    days = windows.select(F.explode(F.sequence("lo_day", "hi_day")).alias("day")).distinct().orderBy("day").collect()
    ranges: list[list] = []
    for (day,) in days:
        if ranges and day - ranges[-1][1] == timedelta(days=1):
            ranges[-1][1] = day
        else:
            ranges.append([day, day])
    wide = sorted(range(1, len(ranges)), key=lambda i: ranges[i][0] - ranges[i - 1][1], reverse=True)[: MOST_RANGES - 1]
    cuts = [0, *sorted(wide), len(ranges)]
    ts = F.col("timestamp")

    def at(day) -> Column:
        return ts_like(panel, "timestamp", datetime(day.year, day.month, day.day))

    parts = [(ts >= at(ranges[a][0])) & (ts < at(ranges[b - 1][1] + timedelta(days=1))) for a, b in zip(cuts, cuts[1:]) if a < b]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _edge_sums(stats: DataFrame, days: DataFrame, edges: DataFrame) -> DataFrame:
    """(day, micros, category) of every edge -> sums of that day before it and up to it.

    Prefix sums at two levels: over the minutes of a day, then over the moments of the edge's minute. Facts and edges lie in one
    order, so nothing is compared pair by pair; the calendar bounds the first level, one minute's moments the second.
    """
    asked = edges.join(days.select("day", "category"), "day")
    minute = F.floor(F.col("micros") / MINUTE)
    none = [F.lit(0).cast("bigint").alias("n_obs"), F.lit(0).cast("bigint").alias("n_rel"), F.lit(0.0).alias("ln_sum")]
    facts = stats.groupBy("day", "category", "minute").agg(*[F.sum(c).alias(c) for c in SUMS])
    starts = asked.select("day", "category", minute.alias("minute"), *none).distinct().withColumn("edge", F.lit(True))
    of_day = W.partitionBy("day", "category").orderBy("minute").rangeBetween(W.unboundedPreceding, -1)
    minutes = facts.withColumn("edge", F.lit(False)).unionByName(starts).select("day", "category", "minute", "edge", *[F.coalesce(F.sum(c).over(of_day), F.lit(0)).alias(f"day_{c}") for c in SUMS])
    moments = stats.where("at IS NOT NULL").select("day", "category", "minute", F.col("at").alias("micros"), *SUMS).withColumn("edge", F.lit(False))
    points = asked.select("day", "category", minute.alias("minute"), "micros", *none).withColumn("edge", F.lit(True))
    of_minute = W.partitionBy("day", "category", "minute").orderBy("micros")
    before, upto = of_minute.rangeBetween(W.unboundedPreceding, -1), of_minute.rangeBetween(W.unboundedPreceding, 0)
    within = moments.unionByName(points).select(
        "day", "category", "minute", "micros", "edge",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in SUMS], *[F.sum(c).over(upto).alias(f"upto_{c}") for c in SUMS],
    )
    both = within.where("edge").drop("edge").join(minutes.where("edge").drop("edge"), ["day", "category", "minute"])
    return both.select("day", "micros", "category", *[(F.col(f"day_{c}") + F.col(f"{side}_{c}")).alias(f"{side}_{c}") for side in ("before", "upto") for c in SUMS])


def index_on_times(panel: DataFrame, times: DataFrame, cfg: IndexConfig) -> DataFrame:
    """Index, rates and interval at a column of instants, any number of them at any time of day, in one job.

    Facts shrink to sums per minute and category; only minutes in which a window begins or ends keep their moments apart. A window is its
    whole days, plus what its last day holds up to its end, less what its first day holds before its start.
    """
    as_of = F.col(times.columns[0]).cast("timestamp_ntz").alias("as_of")
    axis, _ = materialize(times.select(as_of).where(F.col("as_of").isNotNull()).distinct())
    windows = _windows(axis, cfg)
    ends = windows.select(F.col("hi_day").alias("day"), F.col("hi").alias("micros"))
    edges, _ = materialize(ends.unionByName(windows.select(F.col("lo_day").alias("day"), F.col("lo").alias("micros"))).distinct())
    kept, marked = materialize(edges.select("day", F.floor(F.col("micros") / MINUTE).alias("minute"), F.lit(True).alias("marked")).distinct())
    micros = _day_micros(F.col("timestamp"))
    rows = panel.where(_day_filter(panel, windows)).withColumns({"day": F.to_date("timestamp"), "micros": micros, "minute": F.floor(micros / MINUTE)})
    rows = rows.select("day", "minute", "micros", *KEYS, "price").join(F.broadcast(kept) if marked <= BROADCAST_ROWS else kept, ["day", "minute"], "left")
    rows = rows.withColumn("at", F.when(F.col("marked"), F.col("micros")))
    stats, _ = materialize(_statistics(rows, base_prices(panel, cfg), ["day", "minute", "at"]).fillna(0, ["ln_sum"]))
    days = stats.groupBy("day", "category").agg(*[F.sum(c).alias(c) for c in SUMS])
    sums = _edge_sums(stats, days, edges)
    whole = windows.select("as_of", "span", F.explode(F.sequence("lo_day", F.date_sub("hi_day", 1))).alias("day")).join(days, "day").drop("day")
    last = windows.select("as_of", "span", F.col("hi_day").alias("day"), F.col("hi").alias("micros")).join(sums, ["day", "micros"])
    first = windows.select("as_of", "span", F.col("lo_day").alias("day"), F.col("lo").alias("micros")).join(sums, ["day", "micros"])
    parts = whole.unionByName(last.select("as_of", "span", "category", *[F.col(f"upto_{c}").alias(c) for c in SUMS]))
    parts = parts.unionByName(first.select("as_of", "span", "category", *[(-F.col(f"before_{c}")).alias(c) for c in SUMS]))
    found = parts.groupBy("as_of", "span", "category").agg(*[F.sum(c).alias(c) for c in SUMS])
    return index_of_windows(found, axis, cfg)


def index_at(panel: DataFrame, as_ofs: list[datetime], cfg: IndexConfig) -> DataFrame:
    """Index, rates and interval at the given instants, any time of day, in one job."""
    return index_on_times(panel, panel.sparkSession.createDataFrame([(t,) for t in as_ofs], "as_of timestamp_ntz"), cfg)


def index_on_dates(panel: DataFrame, dates: DataFrame, cfg: IndexConfig) -> DataFrame:
    """Same at the midnights of a column of dates, which may come from a table.

    First and last date are read first, so that the scan skips what no window can reach.
    """
    axis = dates.select(F.to_date(dates.columns[0]).cast("timestamp_ntz").alias("as_of")).where("as_of IS NOT NULL").distinct()
    first, last = axis.agg(F.min("as_of"), F.max("as_of")).first()
    needed = panel.where(_reach(panel, first, last, cfg)) if first else panel.limit(0)
    return price_index(day_statistics(needed, base_prices(panel, cfg)), axis, cfg)


def _reach(panel: DataFrame, first: datetime, last: datetime, cfg: IndexConfig) -> Column:
    """Times that a window of an as-of between first and last can hold."""
    back = timedelta(days=max(cfg.year_days, cfg.month_days) + cfg.window_days)
    return F.col("timestamp").between(ts_like(panel, "timestamp", first - back), ts_like(panel, "timestamp", last))


def historical_index(panel: DataFrame, start: datetime, end: datetime, cfg: IndexConfig, freq: str = "D") -> DataFrame:
    """Index series over a date axis: date, index, rates and observation count."""
    axis = date_range(panel.sparkSession, start, end, freq).withColumnRenamed("date", "as_of")
    needed = panel.where(_reach(panel, start, end, cfg))
    phases = _phases([start + timedelta(hours=h) for h in range(24)] if freq == "H" else [start])
    stats = day_statistics(needed, base_prices(panel, cfg), phases)
    return price_index(stats, axis, cfg, phases).select(
        F.col("as_of").alias("date"),
        "price_index",
        "inflation_rate",
        "inflation_yoy",
        "inflation_mom",
        "observation_count",
    )


def category_breakdown(result: DataFrame, cfg: IndexConfig) -> DataFrame:
    """Result rows to one row per index category; defaults where the window was empty."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("category"),
                F.lit(w).alias("weight"),
                F.coalesce(F.try_element_at("category_indices", F.lit(c)), F.lit(100.0)).alias("price_index"),
                F.coalesce(F.try_element_at("category_contributions", F.lit(c)), F.lit(0.0)).alias("contribution"),
            )
            for c, w in cfg.weights.items()
        ]
    )
    return result.select("as_of", F.inline(rows)).select(
        "as_of",
        "category",
        "weight",
        "price_index",
        (F.col("price_index") - 100).alias("inflation_rate"),
        "contribution",
    )

