"""NaN counts as missing in every report."""

from conftest import day

from basketflow.operators import reports


def test_nan_prices_are_missing(observations):
    panel = observations([("p", "grocery", "r", x, day("2024-01-01")) for x in (1.0, 2.0, 3.0, float("nan"), None)])
    row = reports.describe_by_category(panel).first()
    assert (row["count"], row["mean"], row["p50"], row["max"]) == (3, 2.0, 2.0, 3.0)
    assert reports.daily_mean_price(panel).first().avg_price == 2.0
    assert reports.daily_category_mean(panel).first().avg_price == 2.0
    bins = reports.price_histogram(panel, 2).collect()
    assert {(r.bin_start, r.bin_end) for r in bins} == {(1.0, 2.0), (2.0, 3.0)}
