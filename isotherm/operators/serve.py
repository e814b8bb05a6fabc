"""Frames behind the climate and observability dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.columns import ratio

# Selectable monthly metrics.
METRICS = (
    "avg_tmean_c",
    "avg_tmax_c",
    "avg_tmin_c",
    "total_precip_mm",
    "avg_wind_max_ms",
    "avg_dewpoint_c",
    "avg_sw_radiation",
    "heat_day_count",
    "tropical_night_count",
    "heavy_precip_day_count",
    "summer_day_count",
)


def monthly_trend(
    monthly: DataFrame, cities: Sequence[str] | None = None, metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Metrics on the first day of each month, for all or some cities.

    Unselected metrics are never read from the table.
    """
    unknown = set(metrics) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    if cities is not None:
        monthly = monthly.where(F.col("city_name").isin(*cities))
    first_day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    return monthly.select("city_name", "country_code", first_day.alias("date"), *metrics)


def metric_summary(trend: DataFrame, metric: str) -> DataFrame:
    """Mean, sample spread and extremes of one metric per city, to two decimals, half to even."""
    value = F.col(metric).cast("double")
    measures = {
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
        "min": F.min(value),
        "max": F.max(value),
    }
    return trend.groupBy("city_name").agg(
        *[F.bround(column, 2).alias(name) for name, column in measures.items()]
    )


def city_names(monthly: DataFrame) -> DataFrame:
    """Sorted distinct city names."""
    return monthly.select("city_name").distinct().orderBy("city_name")


def success_rate(run_summary: DataFrame) -> DataFrame:
    """Run summary under its dashboard names, with the share of successful runs."""
    return run_summary.select(
        "run_date",
        "flow_name",
        "run_mode",
        F.col("runs_success").alias("success_count"),
        F.col("runs_failed").alias("failure_count"),
        "n_runs",
        ratio(F.col("runs_success"), F.col("n_runs")).alias("success_rate"),
        "rows_bronze_max",
        "rows_gold_ml_max",
        "rows_bronze_delta_max",
        "rows_gold_ml_delta_max",
    )


def latest_per_mode(ml_summary: DataFrame) -> DataFrame:
    """The newest summary row of each run mode. The summary has one row per day and mode."""
    columns = ml_summary.columns
    newest = ml_summary.groupBy("run_mode").agg(
        F.max_by(F.struct(*columns), "run_date").alias("newest")
    )
    return newest.select("newest.*")
