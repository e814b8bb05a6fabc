"""Run log, model metrics log and their summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.functions.columns import freshness
from isotherm.operators.positions import running_totals
from isotherm.schemas import RUN_LOG


def run_log_view(run_log: DataFrame) -> DataFrame:
    """All thirteen columns of the run log, newest run first."""
    return run_log.select(*RUN_LOG.names).orderBy(F.col("started_at").desc())


def ml_metrics_view(metrics: DataFrame) -> DataFrame:
    """The metrics log under its reporting names, newest first."""
    return metrics.select(
        F.col("created_at").alias("run_at"),
        "run_mode",
        F.col("train_size").alias("n_train"),
        "accuracy",
        "roc_auc",
    ).orderBy(F.col("run_at").desc())


def run_daily_summary(run_log: DataFrame) -> DataFrame:
    """Runs per day, flow and mode. A run without status counts as neither success nor failure."""
    succeeded = F.col("status") == "success"
    # by way of the date: truncating a zone-less timestamp would pass through the session zone
    day = F.to_date("started_at").cast("timestamp_ntz")
    peaks = ("rows_bronze", "rows_gold_ml", "rows_bronze_delta", "rows_gold_ml_delta")
    return run_log.groupBy(day.alias("run_date"), "flow_name", "run_mode").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(succeeded).alias("runs_success"),
        F.count_if(~succeeded).alias("runs_failed"),
        F.max("started_at").alias("last_run_at"),
        *[F.max(c).alias(f"{c}_max") for c in peaks],
    )


def ml_daily_summary(metrics: DataFrame) -> DataFrame:
    """Metric averages per day and mode. `last_n_train` is the largest training size."""
    return metrics.groupBy(F.to_date("created_at").alias("run_date"), "run_mode").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.max("created_at").alias("last_run_at"),
        F.max("train_size").alias("last_n_train"),
        F.avg("accuracy").alias("avg_accuracy"),
        F.avg("roc_auc").alias("avg_roc_auc"),
        F.avg("precision_1").alias("avg_precision_pos"),
        F.avg("recall_1").alias("avg_recall_pos"),
        F.avg("f1_1").alias("avg_f1_pos"),
    )


def newest_first(summary: DataFrame) -> DataFrame:
    """Listing order of both summaries: newest day, then flow and mode."""
    names = [c for c in ("flow_name", "run_mode") if c in summary.columns]
    return summary.orderBy(F.col("run_date").desc(), *names)


def with_next_ids(rows: DataFrame, stored: DataFrame, order_by: str | None = None) -> DataFrame:
    """Number rows from the highest stored id on, from 1 in an empty log.

    `order_by` names a unique column; without it rows are numbered in the order of their
    partitions. Either way by running totals, whose ranges are stored with the order in them, so the
    ids hold however often the result is read and a batch of any size never meets in one task.
    """
    highest = stored.select(F.coalesce(F.max("id"), F.lit(0)).alias("highest")).scalar()
    columns = [c for c in rows.columns if c != "id"]
    order = F.col(order_by) if order_by else F.monotonically_increasing_id()
    ordered = rows.withColumns({"_order": order, "_one": F.lit(1)})
    number = F.col("_one_before") + 1
    counted = running_totals(ordered, "_order", ["_one"])
    return counted.select((highest + number).cast("long").alias("id"), *columns)


def last_success(run_log: DataFrame) -> DataFrame:
    """Row counts of the latest successful run, one row, NULLs when there is none."""
    counts = F.struct("rows_bronze", "rows_gold_ml")
    return run_log.where(F.col("status") == "success").agg(
        F.max_by(counts, "started_at").alias("last_success")
    )


def feature_extent(features: DataFrame) -> DataFrame:
    """Row count and first day of the newest (year, month), one row."""
    year, month = F.col("year").cast("int").alias("y"), F.col("month").cast("int").alias("m")
    return features.agg(
        F.count(F.lit(1)).alias("rows_gold_ml"), F.max(F.struct(year, month)).alias("newest")
    ).select(
        "rows_gold_ml", F.make_date("newest.y", "newest.m", F.lit(1)).alias("gold_ml_max_date")
    )


def run_stats(
    landing: DataFrame,
    features: DataFrame,
    run_log: DataFrame,
    as_of: date,
    config: ClimateConfig = ClimateConfig(),
) -> DataFrame:
    """One row: sizes and newest dates of the daily and feature tables, growth, freshness.

    Growth is against the last successful run; the first run grows by everything. Each table is
    reduced to one row with map-side aggregation before the rows meet.
    """
    days = landing.agg(
        F.count(F.lit(1)).alias("rows_bronze"), F.max("date").alias("bronze_max_date")
    )
    extent = feature_extent(features).select(F.struct("rows_gold_ml", "gold_ml_max_date")).scalar()
    before = last_success(run_log).scalar()

    def growth(now, name: str):
        return (now - F.coalesce(before[name], F.lit(0))).alias(f"{name}_delta")

    return days.withColumn("rows_gold_ml", extent["rows_gold_ml"]).select(
        "rows_bronze",
        "rows_gold_ml",
        growth(F.col("rows_bronze"), "rows_bronze"),
        growth(F.col("rows_gold_ml"), "rows_gold_ml"),
        "bronze_max_date",
        extent["gold_ml_max_date"].alias("gold_ml_max_date"),
        freshness(
            F.col("bronze_max_date"), as_of, config.fresh_days, config.stale_days
        ).alias("freshness_status"),
    )
