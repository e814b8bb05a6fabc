"""Every threshold, period and size an operator depends on, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# The daily variables of a raw document.
DAILY_VARIABLES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "dew_point_2m_mean",
    "precipitation_sum",
    "wind_speed_10m_max",
    "shortwave_radiation_sum",
)

# The model's inputs, in the order of the assembled vector, and its target.
FEATURE_COLUMNS = (
    "anomaly_tmean_c",
    "roll_mean_3",
    "roll_mean_6",
    "roll_std_3",
    "roll_std_6",
    "delta_1m",
    "delta_3m",
    "max_lagged_corr",
    "lead_lag_months",
    "sin_month",
    "cos_month",
)
TARGET_COLUMN = "is_event_next_month"


@dataclass(frozen=True)
class ClimateConfig:
    variables: tuple[str, ...] = DAILY_VARIABLES

    # climatology baseline, both years included
    baseline_first_year: int = 1981
    baseline_last_year: int = 2010

    # daily and monthly cut-offs
    heat_day_c: float = 30.0
    tropical_night_c: float = 20.0
    heavy_precip_mm: float = 10.0
    anomaly_c: float = 1.0
    strong_z: float = 2.0
    extreme_z: float = 3.0

    # cross-station correlations; block_size is the size of a small fleet's blocks, not a bound of the result.
    # pair_partitions spreads the block pairs over that many tasks; 0 takes as many as the pairs of
    # cities ask for, since the session sizes partitions by bytes although this work is all computation.
    max_lag: int = 6
    block_size: int = 256
    pair_partitions: int = 0

    # default backfill window
    start_date: date = date(1980, 1, 1)
    end_date: date = date(2024, 12, 31)

    # model
    train_fraction: float = 0.75
    n_trees: int = 300
    max_depth: int = 8
    seed: int = 42
    event_probability: float = 0.5
    model_name: str = "baseline_random_forest"
    model_version: str = "v1"

    # health minima and freshness limits in days
    min_accuracy: float = 0.80
    min_roc_auc: float = 0.60
    min_positive_ratio: float = 0.01
    fresh_days: int = 1
    stale_days: int = 7
