from pyspark.sql import types as T

from isotherm.operators import quality


def counts(report):
    return {r.rule: (r.n_failed, r.passed) for r in report.collect()}


def test_rules_count_failing_rows(spark):
    frame = spark.createDataFrame(
        [(1, 5.0, 1), (None, -61.0, 0), (3, None, 2), (13, 60.0, None), (1, float("nan"), 1)],
        "month int, t double, target int",
    )
    rules = [
        quality.not_null("month"),
        quality.accepted_values("month", range(1, 13)),
        quality.accepted_range("t", -60, 60),
        quality.binary("target"),
        quality.complete_where_labelled("t", "target"),
    ]
    report = quality.check(frame, "x", rules)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert counts(report) == {
        "not_empty": (0, True),
        "not_null(month)": (1, False),
        "accepted_values(month)": (1, False),
        "accepted_range(t)": (2, False),  # NaN sorts above every bound
        "binary(target)": (1, False),
        "complete(t)": (2, False),
    }
    assert {r.n_rows for r in report.collect()} == {5}


def test_open_bounds(spark):
    frame = spark.createDataFrame([(11,), (12,), (None,)], "n int")
    assert counts(quality.check(frame, "x", [quality.accepted_range("n", low=12)]))["accepted_range(n)"] == (1, False)
    assert counts(quality.check(frame, "x", [quality.accepted_range("n", high=12)]))["accepted_range(n)"] == (0, True)


def test_empty_table_fails(spark):
    frame = spark.createDataFrame([], "n int")
    assert counts(quality.check(frame, "x", [quality.not_null("n")])) == {
        "not_empty": (1, False), "not_null(n)": (0, True),
    }


def test_unique(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a int, b int")
    row = quality.check_unique(frame, "x", ["a", "b"]).first()
    assert (row.rule, row.n_rows, row.n_failed, row.passed) == ("unique(a, b)", 6, 2, False)
    assert quality.check_unique(frame.limit(0), "x", ["a"]).first().passed


def test_contract(spark):
    frame = spark.createDataFrame([], "id int, day timestamp, x double, name string")
    contract = T.StructType.fromDDL("id long, day date, x double, n double, name long")
    assert quality.contract_problems(frame, contract) == [
        "missing column: n", "name: expected integer, found string",
    ]
    assert quality.contract_problems(frame, T.StructType.fromDDL("x double, id double")) == []
    assert quality.contract_problems(frame, T.StructType.fromDDL("x long")) == [
        "x: expected integer, found number"
    ]


def test_every_layer_has_rules(spark):
    tables = [
        "landing_daily_weather", "clean_daily_weather_features", "clean_monthly_climate",
        "climatology_city_month", "anomaly_city_month", "anomaly_city_correlations",
        "anomaly_city_lags", "anomaly_city_events", "ml_features", "pipeline_runs",
    ]
    rules = [r for t in tables for r in quality.rules_for(t)]
    assert sum(r.name.startswith("not_null") for r in rules) == 40
    assert sum(r.name.startswith("accepted_values") for r in rules) == 3
    assert sum(r.name.startswith("accepted_range") for r in rules) == 9
