from datetime import date

import pytest

from isotherm.operators import listing, quality
from isotherm.schemas import RUN_LOG


@pytest.mark.parametrize(
    ("name", "schema", "rows"),
    [
        ("anomaly_city_correlations", "anomaly_correlation double, city_id_1 long, city_id_2 long",
         [(0.9, 1, 2), (0.1, 2, 1), (0.1, 2, 3), (-1.0, 0, 1), (None, 0, 0)]),
        ("anomaly_city_lags", "city_name string, other_city_name string, lag_months long",
         [("a", "b", -1), ("a", "b", 2), ("a", "c", 0), ("b", "a", 0), (None, "a", 0)]),
        ("monthly_trend", "date date, city_name string",
         [(date(2020, 1, 1), "a"), (date(2020, 1, 1), "b"), (date(2020, 2, 1), "a")]),
        ("success_rate", "run_date date, run_mode string, flow_name string",
         [(date(2020, 2, 1), "a", "x"), (date(2020, 2, 1), "b", "x"), (date(2020, 1, 1), "a", "x")]),
    ],
)
def test_order(spark, name, schema, rows):
    frame = spark.createDataFrame(rows[::-1], schema).repartition(3)
    assert [tuple(r) for r in listing.listed(frame, name).collect()] == rows


def test_contracts_are_reported_as_checks(spark):
    empty = spark.createDataFrame([], RUN_LOG)
    tables = {"pipeline_run_log": empty.drop("status").withColumnRenamed("id", "number"), "not_declared": empty}
    report = {r.rule: r for r in quality.contract_report(spark, tables).collect()}
    assert set(report) == {"contract"}
    assert report["contract"].n_failed == 2 and not report["contract"].passed
    assert quality.contract_report(spark, {"pipeline_run_log": empty}).first().passed
