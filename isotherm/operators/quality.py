"""Declarative data checks: all rules of a table are counted in one pass over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.config import DAILY_VARIABLES, FEATURE_COLUMNS, TARGET_COLUMN
from isotherm.schemas import ML_METRICS, RUN_LOG


@dataclass(frozen=True)
class Rule:
    """A named condition that marks a row as failing; NULL does not fail it."""

    name: str
    fails: Column


def not_null(column: str) -> Rule:
    return Rule(f"not_null({column})", F.col(column).isNull())


def accepted_values(column: str, values: Sequence) -> Rule:
    return Rule(f"accepted_values({column})", ~F.col(column).isin(*values))


def accepted_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    """Both bounds included, either one optional."""
    value, fails = F.col(column), F.lit(False)
    if low is not None:
        fails = fails | (value < low)
    if high is not None:
        fails = fails | (value > high)
    return Rule(f"accepted_range({column})", fails)


def binary(column: str) -> Rule:
    return Rule(f"binary({column})", ~F.col(column).isin(0, 1))


def complete_where_labelled(column: str, target: str) -> Rule:
    value = F.col(column)
    missing = value.isNull() | F.isnan(value.cast("double"))
    return Rule(f"complete({column})", F.col(target).isNotNull() & missing)


def check(frame: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows seen, rows failing, passed. Adds the rule that the table has rows."""
    counted = frame.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(r.fails).alias(f"rule_{i}") for i, r in enumerate(rules)],
    )
    failures = {"not_empty": (F.col("n_rows") == 0).cast("long")}
    failures |= {r.name: F.col(f"rule_{i}") for i, r in enumerate(rules)}
    results = [
        F.struct(F.lit(name).alias("rule"), n.alias("n_failed")) for name, n in failures.items()
    ]
    return _report(counted.select("n_rows", F.inline(F.array(*results))), table)


def check_unique(frame: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once. Repeats collapse before the shuffle."""
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_failed")
    )
    name = F.lit(f"unique({', '.join(keys)})")
    return _report(counted.select("n_rows", name.alias("rule"), "n_failed"), table)


def _report(results: DataFrame, table: str) -> DataFrame:
    return results.select(
        F.lit(table).alias("table_name"),
        "rule",
        "n_rows",
        "n_failed",
        (F.col("n_failed") == 0).alias("passed"),
    )


def target_values(frame: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """The distinct values of the target."""
    return frame.select(target).distinct()


def contract_problems(frame: DataFrame, contract: T.StructType) -> list[str]:
    """Columns of the contract that are absent or of another kind; reads the schema only.

    Kinds are compared, not exact types: any integer for an integer, any number for a double,
    date or timestamp for a date.
    """

    def kind(data_type: T.DataType) -> str:
        if isinstance(data_type, T.IntegralType):
            return "integer"
        if isinstance(data_type, T.NumericType):
            return "number"
        if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "date"
        return data_type.typeName()

    present = {f.name: kind(f.dataType) for f in frame.schema}
    problems = []
    for field in contract:
        wanted, found = kind(field.dataType), present.get(field.name)
        fits = found == wanted or (wanted == "number" and found == "integer")
        if found is None:
            problems.append(f"missing column: {field.name}")
        elif not fits:
            problems.append(f"{field.name}: expected {wanted}, found {found}")
    return problems


# Columns and kinds of the stored tables.
_CITY = "city_id long, city_name string, country_code string"
_PAIR = "n_observations long, anomaly_correlation double"
CONTRACTS = {
    "landing_daily_weather": f"{_CITY}, city_slug string, year long, date date, "
    + ", ".join(f"{v} double" for v in DAILY_VARIABLES),
    "clean_monthly_climate": f"{_CITY}, year long, month long, days_in_month long, avg_tmax_c double, "
    "avg_tmin_c double, avg_tmean_c double, total_precip_mm double",
    "climatology_city_month": f"{_CITY}, month long, climatology_tmean_c double, climatology_tmean_std_c double",
    "anomaly_city_month": f"{_CITY}, year long, month long, month_name string, season string, "
    "anomaly_tmean_c double, zscore_tmean double, is_strong_positive_temp_anomaly boolean",
    "anomaly_city_events": "city_id long, city_name string, year long, month long, z_score double, "
    "is_hot_event boolean, is_cold_event boolean, is_extreme_event boolean",
    "anomaly_city_correlations": f"city_id_1 long, city_name_1 string, city_id_2 long, city_name_2 string, {_PAIR}",
    "anomaly_city_lags": f"city_id long, other_city_id long, lag_months long, {_PAIR}",
    "ml_features": "city_id long, city_name string, year long, month long, "
    + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    + f", {TARGET_COLUMN} long",
    "pipeline_run_log": RUN_LOG,
    "pipeline_ml_metrics": ML_METRICS,
}


def contract_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with a declared contract: how many of its columns are missing or of another
    kind. Reads schemas only."""
    rows = []
    for name, frame in tables.items():
        if name in CONTRACTS:
            declared = CONTRACTS[name]
            contract = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
            problems = contract_problems(frame, contract)
            rows.append((name, "contract", len(contract), len(problems), not problems))
    return spark.createDataFrame(
        rows, "table_name string, rule string, n_rows long, n_failed long, passed boolean"
    )


MONTHS = tuple(range(1, 13))


def _all_not_null(*columns: str) -> list[Rule]:
    return [not_null(c) for c in columns]


def rules_for(table: str) -> list[Rule]:
    """The standing checks of each layer table."""
    # Checked columns, bounds and accepted values.
    suites = {
        "landing_daily_weather": lambda: _all_not_null("city_id", "date"),
        "clean_daily_weather_features": lambda: _all_not_null("city_id", "date", "tmax_c")
        + [
            accepted_range("tmax_c", -60, 60),
            accepted_range("tmin_c", -60, 60),
            accepted_range("precip_mm", 0, 500),
        ],
        "clean_monthly_climate": lambda: _all_not_null("city_id", "city_name", "year", "month")
        + [accepted_values("month", MONTHS)],
        "climatology_city_month": lambda: _all_not_null("city_id", "city_name", "month")
        + [accepted_values("month", MONTHS)],
        "anomaly_city_month": lambda: _all_not_null("city_id", "city_name", "year", "month")
        + [accepted_values("month", MONTHS)],
        "anomaly_city_correlations": lambda: _all_not_null(
            "city_id_1", "city_name_1", "city_id_2", "city_name_2",
            "n_observations", "anomaly_correlation",
        )
        + [accepted_range("n_observations", low=12), accepted_range("anomaly_correlation", -1, 1)],
        "anomaly_city_lags": lambda: _all_not_null(
            "city_id", "other_city_id", "lag_months", "anomaly_correlation", "n_observations"
        )
        + [accepted_range("lag_months", -6, 6), accepted_range("anomaly_correlation", -1, 1)],
        "anomaly_city_events": lambda: _all_not_null(
            "city_id", "year", "month", "z_score",
            "is_hot_event", "is_cold_event", "is_extreme_event",
        )
        + [accepted_range("month", 1, 12)],
        "ml_features": lambda: _all_not_null("city_id", "year", "month", TARGET_COLUMN)
        + [accepted_range("month", 1, 12), binary(TARGET_COLUMN)]
        + [complete_where_labelled(c, TARGET_COLUMN) for c in FEATURE_COLUMNS],
        "pipeline_runs": lambda: _all_not_null("id", "started_at"),
    }
    return suites[table]()


# The key of each layer table. The clean daily table has the rows of the landed one.
TABLE_KEYS = {
    "landing_daily_weather": ("city_id", "date"),
    "clean_monthly_climate": ("city_id", "year", "month"),
    "climatology_city_month": ("city_id", "month"),
    "anomaly_city_month": ("city_id", "year", "month"),
    "anomaly_city_events": ("city_id", "year", "month"),
    "ml_features": ("city_id", "year", "month"),
}
