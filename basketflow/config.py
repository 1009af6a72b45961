"""Settings of the jobs; plain frozen dataclasses with bounds.

Fixed values: the defaults and bounds here decide results, so they must stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from basketflow.schema import CPI_WEIGHTS

REQUIRED_COLUMNS = ("product_id", "product_name", "price", "category", "retailer", "timestamp")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class IndexConfig:
    base_period: datetime = datetime(2023, 1, 1)
    base_days: int = 30
    window_days: int = 7
    month_days: int = 30
    year_days: int = 365
    min_observations: int = 10
    confidence_level: float = 0.95
    use_weights: bool = True
    # The lagged indices of MoM and YoY stay weighted even when use_weights is off.
    # consistent_lags=True makes them follow use_weights.
    consistent_lags: bool = False
    seasonal_adjustment: bool = True
    weights: dict[str, float] = field(default_factory=lambda: dict(CPI_WEIGHTS))

    def __post_init__(self) -> None:
        _require(0.5 <= self.confidence_level <= 0.99, "confidence_level must lie in [0.5, 0.99]")
        _require(self.min_observations >= 1, "min_observations must be at least 1")
        _require(self.window_days >= 1, "window_days must be at least 1")


@dataclass(frozen=True)
class QualityConfig:
    required_columns: tuple[str, ...] = REQUIRED_COLUMNS
    min_price: float = 0.01
    max_price: float = 100000.0
    price_change_threshold: float = 0.5
    outlier_std_threshold: float = 3.0
    iqr_multiplier: float = 1.5
    min_completeness_ratio: float = 0.95
    max_null_ratio: float = 0.05
    max_data_age_hours: int = 24
    valid_categories: tuple[str, ...] = tuple(CPI_WEIGHTS)

    def __post_init__(self) -> None:
        for name in ("min_price", "max_price", "outlier_std_threshold", "iqr_multiplier", "max_data_age_hours"):
            _require(getattr(self, name) > 0, f"{name} must be positive")
        for name in ("price_change_threshold", "min_completeness_ratio", "max_null_ratio"):
            _require(0 <= getattr(self, name) <= 1, f"{name} must lie in [0, 1]")


@dataclass(frozen=True)
class ForecastConfig:
    model_type: str = "arima"
    horizon: int = 12
    confidence_level: float = 0.95
    seasonal_period: int = 12
    auto_order: bool = True
    arima_order: tuple[int, int, int] = (1, 1, 1)
    # (1, 1, 1): one difference and one AR and MA term at the seasonal lag; (0, 0, 0): none of them.
    seasonal_order: tuple[int, int, int] = (1, 1, 1)
    # True makes "ensemble" an alias of "arima" instead of the mean of ARIMA and ETS.
    ensemble_is_arima: bool = False

    def __post_init__(self) -> None:
        _require(self.model_type in ("arima", "ets", "ensemble"), f"unknown model type: {self.model_type}")
        _require(self.horizon >= 1, "horizon must be at least 1")
        _require(0.5 <= self.confidence_level <= 0.99, "confidence_level must lie in [0.5, 0.99]")
        _require(self.seasonal_period >= 2, "seasonal_period must be at least 2")
        _require(self.seasonal_order in ((0, 0, 0), (1, 1, 1)), "seasonal_order is (0, 0, 0) or (1, 1, 1)")
        p, d, q = self.arima_order
        _require(0 <= p <= 2 and 0 <= q <= 2 and d in (0, 1), "arima_order: p and q up to 2, d up to 1")


@dataclass(frozen=True)
class EtlConfig:
    output_path: str = "data/processed"
    raw_path: str = "data/raw"
    jdbc_url: str | None = None
    jdbc_batch_size: int = 1000
    compression: str = "snappy"
    validate: bool = True
    on_invalid: str = "record"
    retailers: tuple[str, ...] = ("amazon", "walmart")
    categories: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        _require(self.jdbc_batch_size >= 1, "jdbc_batch_size must be at least 1")
        _require(self.on_invalid in ("record", "raise"), "on_invalid is 'record' or 'raise'")
