from datetime import date, datetime

import pytest

from isotherm.operators import health, observe, serve
from isotherm.schemas import ML_METRICS, RUN_LOG
from isotherm.sources import readers, writers

AS_OF = date(2024, 3, 10)


def run(id, status="success", day=1, hour=0, flow="f", mode="daily", bronze=10, gold=5):
    at = datetime(2024, 3, day, hour)
    return (id, flow, mode, status, at, at, bronze, gold, 1, 1, date(2024, 3, day), None, "fresh")


def test_run_daily_summary(spark):
    log = spark.createDataFrame(
        [
            run(1),
            run(2, status=None, hour=5, bronze=99),
            run(3, status="failed", hour=7),
            run(4, day=2, mode="backfill"),
        ],
        RUN_LOG,
    )
    rows = observe.newest_first(observe.run_daily_summary(log)).collect()
    assert [r.run_date.day for r in rows] == [2, 1]
    first = rows[1]
    assert (first.n_runs, first.runs_success, first.runs_failed) == (3, 1, 1)
    assert (first.last_run_at, first.rows_bronze_max) == (datetime(2024, 3, 1, 7), 99)
    rates = {r.run_date.day: r.success_rate for r in serve.success_rate(observe.run_daily_summary(log)).collect()}
    assert rates == {2: 1.0, 1: pytest.approx(1 / 3)}
    assert [r.id for r in observe.run_log_view(log).collect()] == [4, 3, 2, 1]


def stats(spark, log_rows, days=(date(2024, 3, 3),), months=((2023, 12), (2024, 1))):
    landing = spark.createDataFrame([(d,) for d in days], "date date")
    features = spark.createDataFrame(list(months), "year long, month long")
    return observe.run_stats(landing, features, spark.createDataFrame(log_rows, RUN_LOG), AS_OF).first()


def test_run_stats_first_run_and_growth(spark):
    first = stats(spark, [])
    assert (first.rows_bronze, first.rows_bronze_delta, first.rows_gold_ml_delta) == (1, 1, 2)
    assert (first.bronze_max_date, first.gold_ml_max_date) == (date(2024, 3, 3), date(2024, 1, 1))
    assert first.freshness_status == "stale"
    only_failed = stats(spark, [run(1, status="failed"), run(2, status=None)])
    assert only_failed.rows_bronze_delta == 1
    later = stats(spark, [run(1, bronze=3, gold=1), run(2, day=2, bronze=4, gold=7), run(3, "failed", 3, bronze=0)])
    assert (later.rows_bronze_delta, later.rows_gold_ml_delta) == (1 - 4, 2 - 7)
    empty = stats(spark, [], days=(), months=())
    assert (empty.rows_bronze, empty.bronze_max_date, empty.gold_ml_max_date) == (0, None, None)
    assert empty.freshness_status == "unknown"


def test_append_log_numbers_from_one(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([run(0)], RUN_LOG).drop("id")
    assert [r.id for r in writers.append_log(rows, path, RUN_LOG).collect()] == [1]
    log = writers.append_log(rows, path, RUN_LOG)
    assert sorted(r.id for r in log.collect()) == [1, 2]
    assert log.schema == RUN_LOG


def test_batch_ids_continue(spark):
    stored = spark.createDataFrame([run(7)], RUN_LOG)
    batch = spark.range(5).selectExpr("id * 3 as source", "'x' as v")
    numbered = observe.with_next_ids(batch, stored, order_by="source").orderBy("source").collect()
    assert [r.id for r in numbered] == [8, 9, 10, 11, 12]


def test_absent_log_reads_as_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert readers.read_table(spark, path, RUN_LOG, required=False).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, path)
    spark.createDataFrame([], RUN_LOG).write.parquet(path)
    with pytest.raises(ValueError):
        readers.read_table(spark, path)
    assert observe.run_daily_summary(readers.read_table(spark, path, RUN_LOG, required=False)).count() == 0


def metric(id, day, hour=0, mode="daily", accuracy=0.9, auc=0.7, ratio=0.05, n=100):
    at = datetime(2024, 3, day, hour)
    return (id, None, "f", mode, "m", "v", n, 10, ratio, accuracy, auc, *[0.5] * 6, at)


def ml_status(spark, rows):
    metrics = spark.createDataFrame(rows, ML_METRICS)
    return health.ml_health(observe.ml_daily_summary(metrics), metrics).first()


def test_ml_daily_summary_ignores_missing_auc(spark):
    metrics = spark.createDataFrame([metric(1, 1, n=300), metric(2, 1, 5, auc=None, n=200)], ML_METRICS)
    row = observe.ml_daily_summary(metrics).first()
    assert (row.n_runs, row.avg_roc_auc, row.last_n_train) == (2, 0.7, 300)
    assert row.last_run_at == datetime(2024, 3, 1, 5)


def test_ml_health(spark):
    good = ml_status(spark, [metric(1, 1, accuracy=0.1), metric(2, 2)])
    assert (good.exit_code, good.failures, good.run_date) == (0, [], date(2024, 3, 2))
    bad = ml_status(spark, [metric(1, 2, accuracy=0.7, auc=0.5, ratio=0.001)])
    assert bad.exit_code == 1 and bad.failures == ["accuracy", "roc_auc", "positive_class_ratio"]
    # the ratio of the last row of the day counts, the averages are of the whole day
    late = ml_status(spark, [metric(1, 2, 1, ratio=0.001), metric(2, 2, 9, ratio=0.2)])
    assert (late.exit_code, late.positive_class_ratio) == (0, 0.2)
    unknown = ml_status(spark, [metric(1, 2, auc=None)])
    assert unknown.exit_code == 0
    assert ml_status(spark, []).exit_code == 3


def test_latest_per_mode(spark):
    metrics = spark.createDataFrame(
        [metric(1, 1), metric(2, 3, accuracy=0.5), metric(3, 2, mode="backfill")], ML_METRICS
    )
    rows = {r.run_mode: r for r in serve.latest_per_mode(observe.ml_daily_summary(metrics)).collect()}
    assert {m: r.run_date.day for m, r in rows.items()} == {"daily": 3, "backfill": 2}
    assert rows["daily"].avg_accuracy == 0.5


def ingestion(spark, last_days):
    rows = [(i, d) for i, days in last_days.items() for d in days]
    landing = spark.createDataFrame(rows, "city_id long, date date")
    dim = spark.createDataFrame([(1, "Oslo", "NO")], "city_id long, city_name string, country_code string")
    return health.ingestion_health(landing, dim, AS_OF)


@pytest.mark.parametrize(
    "last_days, code",
    [
        ({1: [date(2024, 3, 9)]}, 0),
        ({1: [date(2024, 3, 9)], 2: [date(2024, 3, 5)]}, 1),
        ({1: [date(2024, 3, 9)], 2: [None]}, 1),
        ({1: [date(2024, 3, 5)], 2: [date(2024, 1, 5)]}, 2),
        ({}, 3),
    ],
)
def test_ingestion_status(spark, last_days, code):
    assert health.ingestion_status(ingestion(spark, last_days)).first().exit_code == code


def test_ingestion_report(spark):
    report = ingestion(spark, {1: [date(2024, 3, 1), date(2024, 3, 9)], 2: [date(2024, 3, 1)]})
    rows = {r.city_id: r for r in report.collect()}
    assert (rows[1].first_date.day, rows[1].last_date.day, rows[1].n_days) == (1, 9, 2)
    assert (rows[1].city_name, rows[2].city_name) == ("Oslo", None)
    counts = {r.freshness_status: r.n_cities for r in health.freshness_counts(report).collect()}
    assert counts == {"fresh": 1, "very_stale": 1}


def test_serving_frames(spark):
    monthly = spark.createDataFrame(
        [("b", "X", 2020, 2, 1.005), ("b", "X", 2020, 1, 2.0), ("a", "X", 2020, 1, None)],
        "city_name string, country_code string, year long, month long, avg_tmean_c double",
    )
    trend = serve.monthly_trend(monthly, ["b"], ["avg_tmean_c"])
    assert sorted(r.date for r in trend.collect()) == [date(2020, 1, 1), date(2020, 2, 1)]
    assert [r[0] for r in serve.city_names(monthly).collect()] == ["a", "b"]
    summary = {r.city_name: r for r in serve.metric_summary(serve.monthly_trend(monthly, None, ["avg_tmean_c"]), "avg_tmean_c").collect()}
    assert (summary["b"].mean, summary["b"].max, summary["a"].mean) == (1.5, 2.0, None)
    with pytest.raises(ValueError):
        serve.monthly_trend(monthly, metrics=["no_such"])


def test_predictions_sink(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", 0.25)], "city_id long, city_name string, prob double")
    table, text = str(tmp_path / "t"), str(tmp_path / "c")
    for _ in range(2):
        assert writers.write_predictions(frame, table, text).count() == 1
    back = spark.read.option("header", True).csv(text).collect()
    assert [tuple(r) for r in back] == [("1", "a", "0.25")]
    assert writers.publish_view(frame, "v").sparkSession.table("v").count() == 1
