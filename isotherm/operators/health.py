"""Ingestion and model health reports with their exit codes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.functions.columns import freshness
from isotherm.operators.observe import newest_first

# Exit codes.
HEALTHY, DEGRADED, CRITICAL, NO_DATA = 0, 1, 2, 3


def ingestion_health(
    landing: DataFrame,
    dim_city: DataFrame,
    as_of: date,
    config: ClimateConfig = ClimateConfig(),
) -> DataFrame:
    """First and last day, number of days and freshness per city.

    Days are reduced per city before the dimension is joined, so the join sees one row per city.
    """
    per_city = landing.groupBy("city_id").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("n_days"),
    )
    names = dim_city.select("city_id", "city_name", "country_code")
    return per_city.join(names, "city_id", "left").select(
        "city_id",
        "city_name",
        "country_code",
        "first_date",
        "last_date",
        "n_days",
        freshness(F.col("last_date"), as_of, config.fresh_days, config.stale_days).alias(
            "freshness_status"
        ),
    )


def freshness_counts(report: DataFrame) -> DataFrame:
    """How many cities have which freshness."""
    return report.groupBy("freshness_status").agg(F.count(F.lit(1)).alias("n_cities"))


def ingestion_status(report: DataFrame) -> DataFrame:
    """One row with city counts per class and the exit code; no cities at all is code 3."""
    kinds = ("fresh", "stale", "very_stale", "unknown")
    counts = report.agg(
        F.count(F.lit(1)).alias("n_cities"),
        *[F.count_if(F.col("freshness_status") == k).alias(f"n_{k}") for k in kinds],
    )
    code = (
        F.when(F.col("n_cities") == 0, NO_DATA)
        .when(F.col("n_very_stale") > 0, CRITICAL)
        .when(F.col("n_stale") + F.col("n_unknown") > 0, DEGRADED)
        .otherwise(HEALTHY)
    )
    return counts.withColumn("exit_code", code)


def recent_ml_summary(summary: DataFrame, n: int = 10) -> DataFrame:
    """Preview of the newest summary rows."""
    columns = ("run_date", "run_mode", "n_runs", "last_run_at", "last_n_train",
               "avg_accuracy", "avg_roc_auc")
    return newest_first(summary.select(*columns)).limit(n)


def ml_health(
    summary: DataFrame, metrics: DataFrame, config: ClimateConfig = ClimateConfig()
) -> DataFrame:
    """The newest summary row against the minima: failures and exit code, always one row.

    The positive ratio is that of the last metrics row of the same day and mode; an unknown
    value never fails a minimum.
    """
    newest = recent_ml_summary(summary, 1)
    ratios = metrics.groupBy(F.to_date("created_at").alias("run_date"), "run_mode").agg(
        F.max_by("positive_class_ratio", "created_at").alias("positive_class_ratio")
    )
    checked = newest.join(ratios, ["run_date", "run_mode"], "left")
    minima = {
        "accuracy": ("avg_accuracy", config.min_accuracy),
        "roc_auc": ("avg_roc_auc", config.min_roc_auc),
        "positive_class_ratio": ("positive_class_ratio", config.min_positive_ratio),
    }
    failures = F.array_compact(
        F.array(*[F.when(F.col(c) < low, F.lit(name)) for name, (c, low) in minima.items()])
    )
    found = checked.withColumn("failures", failures)
    # an aggregate without keys yields its one row even when there is no summary
    columns = [*found.columns]
    one = found.agg(F.first(F.struct(*columns)).alias("row"))
    return one.select(
        *[F.col(f"row.{c}").alias(c) for c in columns],
        F.when(F.col("row").isNull(), NO_DATA)
        .when(F.size("row.failures") > 0, DEGRADED)
        .otherwise(HEALTHY)
        .alias("exit_code"),
    )
