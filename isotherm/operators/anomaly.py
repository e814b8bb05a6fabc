"""Baseline climatology, monthly anomalies and anomaly events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.functions.columns import flag, month_name, season, standardize, truth


def climatology(monthly: DataFrame, config: ClimateConfig = ClimateConfig()) -> DataFrame:
    """Baseline mean and sample spread per city and calendar month.

    The year filter sits directly on the monthly table and reaches its scan.
    """
    in_baseline = F.col("year").between(config.baseline_first_year, config.baseline_last_year)
    return (
        monthly.where(in_baseline)
        .groupBy("city_id", "city_name", "country_code", "month")
        .agg(
            F.avg("avg_tmean_c").alias("climatology_tmean_c"),
            F.avg("avg_tmax_c").alias("climatology_tmax_c"),
            F.avg("avg_tmin_c").alias("climatology_tmin_c"),
            F.avg("total_precip_mm").alias("climatology_total_precip_mm"),
            F.stddev_samp("avg_tmean_c").alias("climatology_tmean_std_c"),
            F.stddev_samp("total_precip_mm").alias("climatology_total_precip_std_mm"),
        )
    )


def anomaly_month(
    monthly: DataFrame, climatology: DataFrame, config: ClimateConfig = ClimateConfig()
) -> DataFrame:
    """Monthly values against their climatology: deviations, z-scores and flags.

    No broadcast hint: the climatology grows with the number of cities (12 rows each), so the
    size check is left to the optimizer's threshold and to adaptive execution. The key
    (city, month) holds one row per year on the left, which bounds every group by the calendar.
    """
    baseline = climatology.drop("city_name", "country_code")
    deviations = (
        monthly.select(
            "city_id", "city_name", "country_code", "year", "month",
            "avg_tmean_c", "avg_tmax_c", "avg_tmin_c", "total_precip_mm",
        )
        .join(baseline, ["city_id", "month"], "left")
        .withColumns(
            {
                "anomaly_tmean_c": F.col("avg_tmean_c") - F.col("climatology_tmean_c"),
                "anomaly_tmax_c": F.col("avg_tmax_c") - F.col("climatology_tmax_c"),
                "anomaly_tmin_c": F.col("avg_tmin_c") - F.col("climatology_tmin_c"),
                "anomaly_total_precip_mm": F.col("total_precip_mm")
                - F.col("climatology_total_precip_mm"),
            }
        )
        .withColumns(
            {
                "zscore_tmean": standardize(
                    F.col("anomaly_tmean_c"), F.col("climatology_tmean_std_c")
                ),
                "zscore_total_precip": standardize(
                    F.col("anomaly_total_precip_mm"), F.col("climatology_total_precip_std_mm")
                ),
            }
        )
    )
    warmth, z = F.col("anomaly_tmean_c"), F.col("zscore_tmean")
    return deviations.select(
        "city_id",
        "city_name",
        "country_code",
        "year",
        "month",
        month_name(F.col("month")).alias("month_name"),
        season(F.col("month")).alias("season"),
        "avg_tmean_c",
        "avg_tmax_c",
        "avg_tmin_c",
        "total_precip_mm",
        "climatology_tmean_c",
        "climatology_tmax_c",
        "climatology_tmin_c",
        "climatology_total_precip_mm",
        "climatology_tmean_std_c",
        "climatology_total_precip_std_mm",
        "anomaly_tmean_c",
        "anomaly_tmax_c",
        "anomaly_tmin_c",
        "anomaly_total_precip_mm",
        "zscore_tmean",
        "zscore_total_precip",
        truth(warmth >= config.anomaly_c).alias("is_positive_temp_anomaly"),
        truth(warmth <= -config.anomaly_c).alias("is_negative_temp_anomaly"),
        truth(z >= config.strong_z).alias("is_strong_positive_temp_anomaly"),
        truth(z <= -config.strong_z).alias("is_strong_negative_temp_anomaly"),
    )


def anomaly_events(anomaly: DataFrame, config: ClimateConfig = ClimateConfig()) -> DataFrame:
    """Hot, cold and extreme months by z-score.

    `is_event_next_month` keeps its published name, although here it marks the event of the
    row's own month; the next-month label is made in `features.ml_features`.
    """
    z = F.col("zscore_tmean")
    return anomaly.select(
        "city_id",
        "city_name",
        "year",
        "month",
        F.col("anomaly_tmean_c").alias("temperature_anomaly"),
        z.alias("z_score"),
        truth(z >= config.strong_z).alias("is_hot_event"),
        truth(z <= -config.strong_z).alias("is_cold_event"),
        truth(F.abs(z) >= config.extreme_z).alias("is_extreme_event"),
        flag(F.abs(z) >= config.strong_z).alias("is_event_next_month"),
    )
