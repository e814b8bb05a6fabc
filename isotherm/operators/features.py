"""The model's feature matrix and its next-month label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.config import FEATURE_COLUMNS, TARGET_COLUMN
from isotherm.functions.columns import flag, month_index

ROLLING_COLUMNS = ("roll_mean_3", "roll_mean_6", "roll_std_3", "roll_std_6", "delta_1m", "delta_3m")


def _by_time():
    return Window.partitionBy("city_id").orderBy("time_index")


def rolling_features(anomaly: DataFrame) -> DataFrame:
    """Rolling means and spreads over 3 and 6 rows, and momentum against 1 and 3 rows back.

    Frames count rows, not calendar months. All windows share one partitioning and one order,
    hence one shuffle and one sort; a window partition is one city's months, so its size is
    bounded by the calendar.
    """
    value = F.col("anomaly_tmean_c")
    time = _by_time()
    last_3, last_6 = time.rowsBetween(-2, 0), time.rowsBetween(-5, 0)
    return anomaly.withColumn("time_index", month_index(F.col("year"), F.col("month"))).withColumns(
        {
            "roll_mean_3": F.avg(value).over(last_3),
            "roll_mean_6": F.avg(value).over(last_6),
            "roll_std_3": F.stddev_samp(value).over(last_3),
            "roll_std_6": F.stddev_samp(value).over(last_6),
            "delta_1m": value - F.lag(value, 1).over(time),
            "delta_3m": value - F.lag(value, 3).over(time),
        }
    )


def next_month_label(indexed: DataFrame, drop_unlabelled: bool = False) -> DataFrame:
    """Add the target: is there a strong anomaly in the next calendar month?

    A RANGE frame of exactly one month ahead reads the row that a self join on
    `time_index + 1` would find, within the sort the rolling windows already made. A missing
    next month counts as "no event" unless `drop_unlabelled` asks to leave such rows out.
    """
    strong = F.col("is_strong_positive_temp_anomaly") | F.col("is_strong_negative_temp_anomaly")
    ahead = _by_time().rangeBetween(1, 1)
    next_event = F.max(flag(strong)).over(ahead)
    if drop_unlabelled:
        return indexed.withColumn(TARGET_COLUMN, next_event).where(F.col(TARGET_COLUMN).isNotNull())
    return indexed.withColumn(TARGET_COLUMN, F.coalesce(next_event, F.lit(0)))


def cyclic_month(frame: DataFrame) -> DataFrame:
    angle = F.lit(2) * F.pi() * F.col("month") / F.lit(12)
    return frame.withColumns({"sin_month": F.sin(angle), "cos_month": F.cos(angle)})


def ml_features(
    anomaly: DataFrame, links: DataFrame, drop_unlabelled: bool = False
) -> DataFrame:
    """Complete feature rows with label.

    `links` is the per-city summary of `telecon.best_lag` or `telecon.strongest_links`. It has
    one row per city, which is left to the optimizer's size check.
    """
    needed = anomaly.select(
        "city_id",
        "city_name",
        "year",
        "month",
        "anomaly_tmean_c",
        "is_strong_positive_temp_anomaly",
        "is_strong_negative_temp_anomaly",
    )
    labelled = next_month_label(rolling_features(needed), drop_unlabelled)
    complete = F.lit(True)
    for column in FEATURE_COLUMNS:
        complete = complete & F.col(column).isNotNull()
    return (
        cyclic_month(labelled.join(links, "city_id", "left"))
        .where(complete)
        .select(
            "city_id",
            "city_name",
            "year",
            "month",
            "sin_month",
            "cos_month",
            "anomaly_tmean_c",
            *ROLLING_COLUMNS,
            "max_lagged_corr",
            "lead_lag_months",
            TARGET_COLUMN,
        )
    )
