"""Daily cleaning and the monthly roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.functions.columns import flag

# Landed variable -> column of the clean daily table.
CLEAN_NAMES = {
    "temperature_2m_max": "tmax_c",
    "temperature_2m_min": "tmin_c",
    "temperature_2m_mean": "tmean_c",
    "dew_point_2m_mean": "dewpoint_c",
    "precipitation_sum": "precip_mm",
    "wind_speed_10m_max": "wind_max_ms",
    "shortwave_radiation_sum": "sw_radiation",
}

MONTHLY_KEYS = ("city_id", "city_name", "country_code", "year", "month")


def clean_daily(landing: DataFrame, config: ClimateConfig = ClimateConfig()) -> DataFrame:
    """Rename the variables and add calendar and threshold columns; a narrow projection."""
    day = F.col("date")
    month = F.month(day)
    return landing.select(
        "city_id",
        "city_name",
        "country_code",
        "date",
        *[F.col(old).alias(new) for old, new in CLEAN_NAMES.items()],
        F.year(day).cast("long").alias("year"),
        month.cast("long").alias("month"),
        F.dayofyear(day).cast("long").alias("day_of_year"),
        flag(month.between(6, 8)).alias("is_summer"),
        flag(F.col("temperature_2m_max") >= config.heat_day_c).alias("is_heat_day"),
        flag(F.col("temperature_2m_min") >= config.tropical_night_c).alias("is_tropical_night"),
        flag(F.col("precipitation_sum") >= config.heavy_precip_mm).alias("is_heavy_precip_day"),
    )


def monthly_climate(daily: DataFrame) -> DataFrame:
    """One row per city and month.

    All aggregates are algebraic, so each scan task reduces its days to city-months before the
    single shuffle: a city that owns a third of all rows sends no more than its months.
    """

    def mean(column: str, name: str):
        return F.avg(column).alias(name)

    def total(column: str, name: str):
        return F.sum(column).alias(name)

    return daily.groupBy(*MONTHLY_KEYS).agg(
        F.count(F.lit(1)).alias("days_in_month"),
        mean("tmax_c", "avg_tmax_c"),
        mean("tmin_c", "avg_tmin_c"),
        mean("tmean_c", "avg_tmean_c"),
        mean("dewpoint_c", "avg_dewpoint_c"),
        mean("wind_max_ms", "avg_wind_max_ms"),
        mean("sw_radiation", "avg_sw_radiation"),
        total("precip_mm", "total_precip_mm"),
        total("is_heat_day", "heat_day_count"),
        total("is_tropical_night", "tropical_night_count"),
        total("is_heavy_precip_day", "heavy_precip_day_count"),
        total("is_summer", "summer_day_count"),
    )
