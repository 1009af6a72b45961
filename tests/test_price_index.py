from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import day
from pyspark.sql import functions as F

from basketflow.config import IndexConfig
from basketflow.operators import price_index
from basketflow.schema import CPI_WEIGHTS

CFG = IndexConfig(base_period=day("2024-01-01"), min_observations=2)
AS_OF = day("2025-03-01")


def naive(pdf, as_of, cfg):
    """The definition, window by window and category by category."""
    base_rows = pdf[(pdf.timestamp >= cfg.base_period) & (pdf.timestamp < cfg.base_period + timedelta(days=30))]
    base = base_rows.groupby(["product_id", "category"]).price.mean().rename("base").reset_index()

    def window(days):
        hi = as_of - timedelta(days=days)
        rows = pdf[(pdf.timestamp >= hi - timedelta(days=cfg.window_days)) & (pdf.timestamp <= hi)]
        out = {}
        for c in CPI_WEIGHTS:
            m = rows[rows.category == c].merge(base[base.category == c], on="product_id")
            out[c] = float(np.exp(np.log(m.price / m.base).mean()) * 100) if len(m) >= cfg.min_observations else 100.0
        return len(rows), out

    n, cur = window(0)
    if n == 0:
        return {"observation_count": 0, "price_index": 100.0, "inflation_mom": 0.0, "inflation_yoy": 0.0, "ci_lower": 0.0, "ci_upper": 0.0}
    weighted = lambda d: sum(d[c] * w for c, w in CPI_WEIGHTS.items())
    total = weighted(cur) if cfg.use_weights else float(np.mean(list(cur.values())))
    rates = {}
    for name, days in (("mom", 30), ("yoy", 365)):
        k, old = window(days)
        rates[name] = (total / weighted(old) - 1) * 100 if k else 0.0
    values = np.array(list(cur.values()))
    half = 2.364624251592808 * values.std(ddof=1) / np.sqrt(8)
    return {
        "observation_count": n, "price_index": total, "inflation_mom": rates["mom"], "inflation_yoy": rates["yoy"],
        "ci_lower": values.mean() - half, "ci_upper": values.mean() + half,
    }


@pytest.fixture(scope="module")
def random_panel(spark):
    rng = np.random.default_rng(4)
    n = 6000
    start = np.datetime64("2024-01-01")
    minutes = rng.integers(0, 460 * 24 * 12, n) * 5
    cats = np.array([*CPI_WEIGHTS, "electronics"])[rng.integers(0, 9, n)]
    pdf = pd.DataFrame(
        {
            "product_id": [f"{c}_{k}" for c, k in zip(cats, rng.integers(0, 6, n))],
            "category": cats,
            "retailer": "r",
            "price": rng.uniform(5, 100, n),
            "timestamp": start + minutes.astype("timedelta64[m]"),
        }
    )
    pdf.loc[pdf.index % 3 == 0, ["product_id", "category"]] = ["hot", "grocery"]  # a third of all rows
    midnights = pdf.sample(400, random_state=1).assign(timestamp=lambda d: d.timestamp.dt.floor("D"))
    pdf = pd.concat([pdf, midnights], ignore_index=True)
    pdf["timestamp"] = pdf["timestamp"].astype("datetime64[us]")
    sdf = spark.createDataFrame(pdf).withColumn("timestamp", price_index.F.col("timestamp").cast("timestamp_ntz"))
    return pdf, sdf.persist()


TIMES = [day("2025-03-01"), day("2025-03-01T12:30:00"), day("2025-02-14T06:05:00"), day("2025-03-20"), day("2030-01-01")]


def compare(result, pdf, cfg, key="as_of"):
    for row in result.collect():
        for name, value in naive(pdf, row[key], cfg).items():
            if name in row.asDict():
                assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-9), (row[key], name)


@pytest.mark.parametrize("weights", [True, False])
def test_any_time_of_day(random_panel, weights):
    pdf, sdf = random_panel
    cfg = IndexConfig(base_period=CFG.base_period, min_observations=5, use_weights=weights)
    result = price_index.index_at(sdf, TIMES, cfg)
    assert result.count() == len(TIMES)
    compare(result, pdf, cfg)


def test_many_instants_at_once(random_panel, spark):
    """Instants on, just before and just after the rows' own times, many of them on one day, and repeated ones."""
    pdf, sdf = random_panel
    rng = np.random.default_rng(5)
    times = [t.to_pydatetime() + timedelta(microseconds=int(d)) for t, d in zip(pdf.timestamp.sample(60, random_state=2), rng.integers(-1, 2, 60))]
    times += [day("2025-02-14") + timedelta(seconds=int(s)) for s in rng.integers(0, 86_400, 60)]
    axis = spark.createDataFrame([(t,) for t in [*times, times[0], None]], "asked timestamp_ntz")
    result = price_index.index_on_times(sdf, axis, CFG)
    assert sorted(r.as_of for r in result.collect()) == sorted(set(times))
    compare(result, pdf, CFG)


def test_scan_filter_names_few_ranges(spark, observations):
    """Hundreds of windows far apart: the nearest ranges are joined, none is left out."""
    times = spark.createDataFrame([(day("2000-01-01") + timedelta(days=40 * i + i * i % 7),) for i in range(300)], "as_of timestamp_ntz")
    cfg = IndexConfig(month_days=13, year_days=21)
    rows = observations([("p", "grocery", "r", 1.0, day("2000-01-01") + timedelta(days=i)) for i in range(-40, 12_100)])
    windows = price_index._windows(times, cfg)
    text = str(price_index._day_filter(rows, windows)._jc)
    assert text.count(">=") <= price_index.MOST_RANGES
    kept = rows.where(price_index._day_filter(rows, windows))
    needed = windows.select(F.explode(F.sequence("lo_day", "hi_day")).alias("d")).distinct()
    assert kept.join(needed, F.to_date("timestamp") == F.col("d")).count() == rows.join(needed, F.to_date("timestamp") == F.col("d")).count()
    assert kept.count() < rows.count()


def test_many_products_path(random_panel, monkeypatch):
    """With too many products to broadcast, products are reduced before the join."""
    monkeypatch.setattr(price_index, "BROADCAST_ROWS", 0)
    pdf, sdf = random_panel
    compare(price_index.index_at(sdf, TIMES, CFG), pdf, CFG)


def test_history_at_midnight_and_noon(random_panel):
    pdf, sdf = random_panel
    for start in (day("2025-02-01"), day("2025-02-01T12:00:00")):
        result = price_index.historical_index(sdf, start, start + timedelta(days=12), CFG)
        assert result.count() == 13
        compare(result, pdf, CFG, "date")


@pytest.mark.parametrize("freq,points", [("H", 6), ("MS", 2)])
def test_history_at_other_steps(random_panel, freq, points):
    pdf, sdf = random_panel
    start = day("2025-02-10T09:30:00") if freq == "H" else day("2025-01-20T12:00:00")
    end = start + (timedelta(hours=5) if freq == "H" else timedelta(days=45))
    result = price_index.historical_index(sdf, start, end, CFG, freq)
    assert result.count() == points
    compare(result, pdf, CFG, "date")


def test_dates_from_a_table(random_panel, spark):
    pdf, sdf = random_panel
    dates = spark.sql("SELECT DATE '2025-02-01' d UNION ALL SELECT DATE '2025-03-01' UNION ALL SELECT DATE '2025-03-01'")
    result = price_index.index_on_dates(sdf, dates, CFG)
    assert result.count() == 2
    compare(result, pdf, CFG)


def base_rows(product="a", category="grocery", price=10.0):
    return [(product, category, "r", price, day("2024-01-05"))]


def index_of(observations, rows, cfg=CFG, as_of=AS_OF):
    return price_index.index_at(observations(rows), [as_of], cfg).first()


def test_window_is_closed_on_both_ends(observations):
    edge = [day("2025-02-22"), AS_OF]
    outside = [day("2025-02-21T23:59:59"), day("2025-03-01T00:00:01")]
    rows = base_rows() + [("a", "grocery", "r", 20.0, t) for t in edge + outside]
    row = index_of(observations, rows)
    assert row.observation_count == 2 and row.category_indices["grocery"] == pytest.approx(200.0)


def test_base_period_is_half_open(observations):
    rows = base_rows() + [("a", "grocery", "r", 30.0, day("2024-01-31")), ("a", "grocery", "r", 14.0, day("2024-01-30T23:59:59"))]
    base = price_index.base_prices(observations(rows), CFG).collect()
    assert [r.base_price for r in base] == [12.0]


@pytest.mark.parametrize("matched,index", [(9, 100.0), (10, 200.0)])
def test_minimum_of_observations(observations, matched, index):
    rows = base_rows() + [("a", "grocery", "r", 20.0, AS_OF)] * matched + [("new", "grocery", "r", 5.0, AS_OF)] * 5
    row = index_of(observations, rows, IndexConfig(base_period=CFG.base_period))
    assert row.category_indices["grocery"] == pytest.approx(index)
    assert row.observation_count == matched + 5


def test_zero_and_missing_prices_are_left_out(observations):
    rows = base_rows() + [("a", "grocery", "r", x, AS_OF) for x in (20.0, 20.0, 0.0, float("nan"), None)]
    row = index_of(observations, rows)
    assert row.observation_count == 5 and row.category_indices["grocery"] == pytest.approx(200.0)


def test_geometric_mean_and_contribution(observations):
    rows = base_rows() + [("a", "grocery", "r", 5.0, AS_OF), ("a", "grocery", "r", 80.0, AS_OF)]
    result = price_index.index_at(observations(rows), [AS_OF], CFG)
    parts = {r.category: r for r in price_index.category_breakdown(result, CFG).collect()}
    assert len(parts) == 8
    assert parts["grocery"].price_index == pytest.approx(200.0)
    assert parts["grocery"].contribution == pytest.approx(14.3)
    assert result.first().price_index == pytest.approx(114.3)


def test_empty_window_gives_defaults(observations):
    row = index_of(observations, base_rows(), as_of=day("2026-01-01"))
    assert (row.price_index, row.inflation_rate, row.observation_count, row.ci_lower, row.ci_upper) == (100.0, 0.0, 0, 0.0, 0.0)
    assert row.category_indices == {} and not row.is_seasonally_adjusted
    parts = price_index.category_breakdown(price_index.index_at(observations(base_rows()), [day("2026-01-01")], CFG), CFG)
    assert {(r.price_index, r.contribution) for r in parts.collect()} == {(100.0, 0.0)}


def test_fallback_base_takes_all_rows_of_the_earliest_days(observations):
    rows = [("a", "grocery", "r", float(i), day("2025-01-01T07:00") + timedelta(hours=i)) for i in range(3000)]
    cfg = IndexConfig(base_period=day("2020-01-01"))
    assert price_index.base_prices(observations(rows), cfg).first().base_price == (30 * 24 - 1) / 2


def test_lagged_indices_stay_weighted_unless_told(observations):
    rows = base_rows()
    for days in (0, 30):
        rows += [("a", "grocery", "r", 20.0, AS_OF - timedelta(days=days))] * 2
    plain = index_of(observations, rows, IndexConfig(base_period=CFG.base_period, min_observations=2, use_weights=False))
    same = index_of(observations, rows, IndexConfig(base_period=CFG.base_period, min_observations=2, use_weights=False, consistent_lags=True))
    assert plain.inflation_mom == pytest.approx((112.5 / 114.3 - 1) * 100)
    assert same.inflation_mom == pytest.approx(0.0)


def test_flat_indices_have_a_point_interval(observations):
    row = index_of(observations, base_rows() + [("a", "grocery", "r", 10.0, AS_OF)] * 2)
    assert (row.ci_lower, row.ci_upper) == pytest.approx((100.0, 100.0))


def test_filters_reach_the_scan(spark):
    from conftest import SF

    from basketflow.sources.panels import lineitem_panel

    result = price_index.index_at(lineitem_panel(spark, SF), [datetime(1999, 1, 15)], IndexConfig(base_period=datetime(1997, 1, 1)))
    plan = result._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-01-08T00:00)" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
