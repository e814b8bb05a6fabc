"""The batch job: land, build the layers, check, train, score, log the run.

    spark-submit --py-files isotherm.zip job.py --raw ... --dim-city ... --warehouse ...
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.config import TARGET_COLUMN, ClimateConfig
from isotherm.functions.columns import slugify
from isotherm.operators import anomaly as anomalies
from isotherm.operators import clean, comoments, features, landing, ml, observe, quality, telecon, windows
from isotherm.schemas import ML_METRICS, RUN_LOG
from isotherm.sources import readers, writers, zone
from isotherm.sources.ledger import Ledger, content_fingerprint
from isotherm.sources.scratch import briefly_staged

log = logging.getLogger(__name__)

# Name of a run in the logs, by mode.
FLOW_NAMES = {
    "daily": "station-climate-daily",
    "backfill": "station-climate-backfill",
    "coverage": "station-climate-coverage",
}

# Versions of the stored correlation sums after which they are made one.
MOST_VERSIONS = 8


class ChecksFailed(RuntimeError):
    """At least one data check found failing rows."""


@dataclass(frozen=True)
class Locations:
    """Where a run reads and writes; all of them shared storage.

    `zoned` says that `raw` is a landing zone written by `writers.land_documents`, instead of one file
    per city and year.
    """

    raw: str
    dim_city: str
    warehouse: str
    zoned: bool = False

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"


def land(
    spark: SparkSession, where: Locations, config: ClimateConfig, year: int | None = None
) -> list[int]:
    """Valid documents into the daily table, invalid ones into quarantine.

    `year` limits the scan; a year without documents loads nothing. Returns the years of the daily
    table that were rewritten, which may be others: a document holds the days it holds. The
    documents are parsed once; both outputs read the parsed columns.
    """
    if where.zoned:
        raw = readers.read_landed_documents(spark, where.raw, config.variables)
        raw = raw if year is None else raw.where(F.col("year") == year)
    else:
        raw = readers.read_raw_daily(spark, where.raw, config.variables, year)
        file_year = F.regexp_extract("file_path", r"(\d+)\.json$", 1).try_cast("long")
        raw = landing.with_city_slug(raw).withColumn("year", file_year)
    return _load(spark, where, config, raw, year)


def plan_missing(
    spark: SparkSession, where: Locations, config: ClimateConfig, as_of: date
) -> DataFrame:
    """The windows of missing days up to the day before `as_of`, stored as a table."""
    landed = readers.read_table(
        spark, where.table("landing_daily_weather"), T.StructType.fromDDL("city_slug string, date date"), required=False
    )
    last = min(config.end_date, as_of - timedelta(days=1))
    cities = readers.read_dim_city(spark, where.dim_city)
    plan = windows.missing_windows(cities, landed, config.start_date, last, config=config)
    return writers.write_table(plan, where.table("window_plan"), sort_by=["city_id", "window_start"])


def land_missing(
    spark: SparkSession, where: Locations, config: ClimateConfig, as_of: date
) -> list[int]:
    """Load the documents of the planned windows alone; what is still missing afterwards stays in the plan.

    Files are listed by many tasks and only those of a planned city and year are opened.
    """
    planned = plan_missing(spark, where, config, as_of).select("city_slug", "year").distinct()
    if where.zoned:
        raw = readers.read_landed_documents(spark, where.raw, config.variables)
        raw = raw.join(planned, ["city_slug", "year"], "left_semi")
    else:
        listing = zone.list_documents(spark, where.raw).join(planned, ["city_slug", "year"], "left_semi")
        raw = zone.documents_at(listing, where.raw, config.variables)
    years = _load(spark, where, config, raw, None, keep_quarantine=True)
    plan_missing(spark, where, config, as_of)
    return years


def _load(
    spark: SparkSession,
    where: Locations,
    config: ClimateConfig,
    raw: DataFrame,
    year: int | None,
    keep_quarantine: bool = False,
) -> list[int]:
    dim_city = readers.read_dim_city(spark, where.dim_city)
    with briefly_staged(landing.validate_raw(raw, config.variables), "documents") as documents:
        good, bad = landing.split_valid(documents)
        if not keep_quarantine or not bad.isEmpty():
            _quarantine(spark, bad, where.table("quarantined_documents"), year, keep_quarantine)
        days = landing.attach_city(landing.flatten_daily(good, config.variables), dim_city)
        return writers.upsert_daily(
            days, where.table("landing_daily_weather"), order_by="modified_at"
        )


def _quarantine(spark: SparkSession, bad: DataFrame, path: str, year: int | None, by_file: bool = False) -> None:
    """Replace the quarantined documents of the files that were read, and keep the others.

    Read were those of `year`, or all; `by_file`: those that are bad now, whatever else was read.
    """
    rows = bad.select(
        "file_path", "city_slug", "modified_at", "n_records", "errors", F.col("year").alias("file_year")
    )
    if year is not None and readers.table_exists(spark, path):
        rows = rows.unionByName(spark.read.parquet(path).where(~F.col("file_year").eqNullSafe(year)))
    elif by_file and readers.table_exists(spark, path):
        rows = rows.unionByName(spark.read.parquet(path).join(rows.select("file_path"), "file_path", "left_anti"))
    with briefly_staged(rows, "quarantine") as current:
        writers.write_table(current, path)


def build_layers(
    spark: SparkSession,
    where: Locations,
    config: ClimateConfig,
    years: list[int] | None = None,
    store_lags: bool = True,
    ledger: Ledger | None = None,
) -> dict[str, DataFrame]:
    """All derived tables, each stored because later ones read it more than once.

    With `years`, only those years of the monthly table are computed again; the daily scan is pruned
    to their partitions, and the correlations come from stored sums into which only the changed
    months go. `store_lags=False` skips the two pair tables, whose size grows with the square of the
    number of cities, and takes the per-city summary straight from the series. With a `ledger`, a
    table whose inputs are unchanged since it was stored is left as it is.
    """
    daily = readers.read_table(spark, where.table("landing_daily_weather"))
    cleaned = writers.publish_view(clean.clean_daily(daily, config), "clean_daily_weather_features")
    settings = [repr(config), store_lags]

    def store(
        name: str, build: Callable[[], DataFrame], sort_by: Sequence[str] = (), after: Sequence[str] = (), write=None
    ) -> DataFrame:
        path = where.table(name)

        def action() -> None:
            if write:
                write(path)
            else:
                writers.write_table(build(), path, sort_by=sort_by)

        if ledger is None:
            action()
        else:
            inputs = {"settings": settings, "after": ledger.tokens(*after), "years": years}
            ledger.step(name, inputs, action, lambda: readers.table_exists(spark, path))
        return spark.read.parquet(path)

    def write_months(path: str) -> None:
        if years is None or not readers.table_exists(spark, path):
            writers.write_table(clean.monthly_climate(cleaned), path, ["year"])
        elif years:
            touched = clean.monthly_climate(clean.clean_daily(writers.of_years(daily, years), config))
            touched.write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("year").parquet(path)

    monthly = store("clean_monthly_climate", None, after=["land"], write=write_months)
    monthly = monthly.withColumn("year", F.col("year").cast("long"))
    climate = store(
        "climatology_city_month",
        lambda: anomalies.climatology(monthly, config),
        ["city_id", "month"],
        ["clean_monthly_climate"],
    )
    anomaly = store(
        "anomaly_city_month",
        lambda: anomalies.anomaly_month(monthly, climate, config),
        ["city_name", "year", "month"],
        ["clean_monthly_climate", "climatology_city_month"],
    )
    layers = {
        "landing_daily_weather": daily,
        "clean_daily_weather_features": cleaned,
        "clean_monthly_climate": monthly,
        "climatology_city_month": climate,
        "anomaly_city_month": anomaly,
        "anomaly_city_events": store(
            "anomaly_city_events",
            lambda: anomalies.anomaly_events(anomaly, config),
            ["city_id", "year", "month"],
            ["anomaly_city_month"],
        ),
    }
    links_after = ["anomaly_city_month"]
    if store_lags:
        stored = comoments.StoredLinks(spark, where.table("anomaly_co_moments"))

        def write_moments(path: str) -> None:
            stored.update(anomaly, config)
            if stored.depth() > MOST_VERSIONS:
                stored.compact()

        incremental = years is not None
        if incremental:
            store("anomaly_co_moments", None, after=["anomaly_city_month"], write=write_moments)
            links_after = ["anomaly_co_moments"]
        layers["anomaly_city_correlations"] = store(
            "anomaly_city_correlations",
            lambda: stored.correlations() if incremental else telecon.pair_correlations(anomaly, config),
            ["city_id_1", "city_id_2"],
            links_after,
        )
        layers["anomaly_city_lags"] = store(
            "anomaly_city_lags",
            lambda: stored.lags() if incremental else telecon.lag_correlations(anomaly, config),
            ["city_name", "other_city_name", "lag_months"],
            links_after,
        )
        links_after = ["anomaly_city_lags"]

    def features_of() -> DataFrame:
        links = telecon.best_lag(layers["anomaly_city_lags"]) if store_lags else telecon.strongest_links(anomaly, config)
        return features.ml_features(anomaly, links)

    layers["ml_features"] = store(
        "ml_features", features_of, ["city_id", "year", "month"], ["anomaly_city_month", *links_after]
    )
    return layers


def run_checks(
    layers: dict[str, DataFrame],
    where: Locations,
    years: list[int] | None = None,
    dim_city: DataFrame | None = None,
) -> DataFrame:
    """Counts of all standing rules and key checks, stored as a table.

    With `years`, the two daily tables are checked for those years only: the run changed no
    other, and the check would otherwise read and shuffle the whole history. With `dim_city`, city
    names that lead to the same slug are counted, since each would receive the other's days.
    """
    if years is not None:
        daily = ("landing_daily_weather", "clean_daily_weather_features")
        layers = layers | {name: writers.of_years(layers[name], years) for name in daily}
    reports = [quality.check(f, name, quality.rules_for(name)) for name, f in layers.items()]
    reports += [
        quality.check_unique(layers[name], name, keys)
        for name, keys in quality.TABLE_KEYS.items()
        if name in layers
    ]
    if dim_city is not None:
        slugs = dim_city.select(slugify(F.col("city_name")).alias("city_slug"))
        reports.append(quality.check_unique(slugs, "dim_city", ["city_slug"]))
    reports.append(quality.contract_report(next(iter(layers.values())).sparkSession, layers))
    combined = reports[0]
    for report in reports[1:]:
        combined = combined.unionByName(report)
    return writers.write_table(combined.coalesce(1), where.table("check_results"))


def train_and_score(
    spark: SparkSession, where: Locations, config: ClimateConfig, run_mode: str
) -> DataFrame:
    """Fit, evaluate, store model, metrics and predictions. Failing to log metrics is not fatal."""
    rows = readers.read_table(spark, where.table("ml_features"))
    marked = writers.write_table(
        ml.mark_split(rows, config.train_fraction), where.table("ml_split")
    )
    train, test = ml.sides(marked)
    model = ml.train_forest(train, config)
    writers.save_model(model, where.table("models/baseline_rf"))

    scored_test = writers.write_table(
        ml.score(test, model, config.event_probability, keep=[TARGET_COLUMN]),
        where.table("ml_test_predictions"),
    )
    try:
        record = ml.metrics_record(train, scored_test, config, FLOW_NAMES[run_mode], run_mode)
        stamped = record.withColumn("created_at", _utc_literal(_utc_now()))
        writers.write_metrics_document(
            ml.metrics_document(stamped, scored_test), where.table("models/baseline_rf_metrics")
        )
        writers.append_log(stamped, where.table("pipeline_ml_metrics"), ML_METRICS)
    except Exception:
        log.exception("could not log the model metrics")

    predictions = ml.score(rows, model, config.event_probability)
    return writers.write_predictions(
        predictions, where.table("ml_predictions"), where.table("ml_predictions_csv")
    )


def log_run(
    spark: SparkSession,
    where: Locations,
    config: ClimateConfig,
    run_mode: str,
    status: str,
    started_at: datetime,
    as_of: date,
) -> None:
    """Append the run record, also for a failed run. Never fails the run itself."""
    try:
        tables = [
            readers.read_table(spark, where.table(name), schema, required=False)
            for name, schema in (
                ("landing_daily_weather", "date date"),
                ("ml_features", "year long, month long"),
                ("pipeline_run_log", RUN_LOG),
            )
        ]
        record = observe.run_stats(*tables, as_of, config).withColumns(
            {
                "flow_name": F.lit(FLOW_NAMES[run_mode]),
                "run_mode": F.lit(run_mode),
                "status": F.lit(status),
                "started_at": _utc_literal(started_at),
                "finished_at": _utc_literal(_utc_now()),
            }
        )
        writers.append_log(record, where.table("pipeline_run_log"), RUN_LOG)
    except Exception:
        log.exception("could not log the run")


def run_job(
    spark: SparkSession,
    where: Locations,
    config: ClimateConfig = ClimateConfig(),
    mode: Literal["daily", "backfill", "coverage"] = "daily",
    with_checks: bool = True,
    as_of: date | None = None,
    store_lags: bool = True,
    resume: bool = True,
    after_step: Callable[[str], None] | None = None,
) -> DataFrame:
    """One run; returns the predictions.

    `daily` reads only the documents of the year of `as_of`, and computes again the months of every
    year that those documents touch. `backfill` reads all. `coverage` plans the windows of missing
    days and reads only their documents; the table `window_plan` then holds what is still missing.

    Each step starts from stored tables and is written to a ledger with a fingerprint of what it
    read. A run that died is started again and goes on behind its last finished step; `resume=False`
    does everything again. `after_step` is called with the name of each step done.
    """
    if mode not in FLOW_NAMES:
        raise ValueError(f"unknown mode: {mode}")
    started_at = _utc_now()
    as_of = as_of or started_at.date()
    year = as_of.year if mode == "daily" else None
    status = "failed"
    try:
        ledger = Ledger(spark, where.table("run_ledger"), after_step)
        if not resume:
            ledger.lines.clear()
        has = lambda name: lambda: readers.table_exists(spark, where.table(name))
        settings = {"mode": mode, "config": repr(config), "lags": store_lags, "checks": with_checks}

        def load() -> list[int]:
            if mode == "coverage":
                return land_missing(spark, where, config, as_of)
            return land(spark, where, config, year)

        landing_inputs = {**settings, "year": year, "raw": _raw_fingerprint(spark, where, year)}
        if mode == "coverage":  # what is missing depends on the day
            landing_inputs["as_of"] = as_of.isoformat()
        touched = ledger.step("land", landing_inputs, load, has("landing_daily_weather"))
        years = None if mode == "backfill" else touched
        layers = build_layers(spark, where, config, years, store_lags, ledger)
        tables = ["land", *[n for n in layers if n in ledger.lines]]
        if with_checks:

            def check() -> int:
                dim_city = readers.read_dim_city(spark, where.dim_city)
                results = run_checks(layers, where, years, dim_city)
                return results.where(~F.col("passed")).count()

            failing = ledger.step(
                "checks", {**settings, "after": ledger.tokens(*tables)}, check, has("check_results")
            )
            if failing:
                raise ChecksFailed(f"{failing} checks failed, see {where.table('check_results')}")

        def train() -> None:
            train_and_score(spark, where, config, mode)

        ledger.step("train", {**settings, "after": ledger.tokens("ml_features")}, train, has("ml_predictions"))
        predictions = spark.read.parquet(where.table("ml_predictions"))
        status = "success"
        return predictions
    finally:
        log_run(spark, where, config, mode, status, started_at, as_of)


def _raw_fingerprint(spark: SparkSession, where: Locations, year: int | None) -> list[str]:
    """Of the documents that a run may read, and of the city dimension."""
    if where.zoned:
        found = readers.landed_files(spark, where.raw)
    else:
        found = zone.list_documents(spark, where.raw)
    if year is not None:
        found = found.where(F.col("year") == year)
    cities = spark.read.text(where.dim_city).select(
        F.col("value").alias("file_path"), F.lit(None).cast("timestamp").alias("modified_at")
    )
    return [content_fingerprint(found), content_fingerprint(cities)]


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _utc_literal(moment: datetime) -> Column:
    """A zone-less literal, whatever the zones of the session and of this process."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def main() -> None:
    arguments = argparse.ArgumentParser(description=__doc__)
    arguments.add_argument("--raw", required=True)
    arguments.add_argument("--dim-city", required=True)
    arguments.add_argument("--warehouse", required=True)
    arguments.add_argument("--mode", choices=sorted(FLOW_NAMES), default="daily")
    arguments.add_argument("--no-checks", action="store_true")
    arguments.add_argument("--no-pair-tables", action="store_true", help="skip the tables of all city pairs")
    arguments.add_argument("--from-scratch", action="store_true", help="do finished steps again")
    arguments.add_argument("--zoned", action="store_true", help="raw is a partitioned landing zone")
    given = arguments.parse_args()
    spark = SparkSession.builder.appName("isotherm").getOrCreate()
    where = Locations(given.raw, given.dim_city, given.warehouse, given.zoned)
    run_job(spark, where, mode=given.mode, with_checks=not given.no_checks,
            store_lags=not given.no_pair_tables, resume=not given.from_scratch)


if __name__ == "__main__":
    main()
