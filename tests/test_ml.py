import itertools
import random

import pytest
from pyspark.sql import functions as F

from isotherm.config import FEATURE_COLUMNS, TARGET_COLUMN, ClimateConfig
from isotherm.operators import ml
from isotherm.sources import writers

SMALL = ClimateConfig(n_trees=5, max_depth=3)


def feature_rows(spark, n_cities=4, n_months=24, seed=3):
    """City 2 has ten times the months of the others; events follow the anomaly."""
    rng = random.Random(seed)
    rows = []
    for c in range(n_cities):
        for t in range(n_months * (10 if c == 2 else 1)):
            x = rng.gauss(0, 1)
            noise = [rng.random() for _ in FEATURE_COLUMNS[1:]]
            rows.append((c, f"city {c}", 1980 + t // 12, t % 12 + 1, x, *noise, int(x > 0.8)))
    columns = "city_id long, city_name string, year long, month long, " + ", ".join(
        f"{c} double" for c in FEATURE_COLUMNS
    )
    return spark.createDataFrame(rows, f"{columns}, {TARGET_COLUMN} int")


@pytest.fixture(scope="module")
def rows(spark):
    frame = feature_rows(spark).persist()
    yield frame
    frame.unpersist()


def test_ordered_split_is_positional(spark, rows):
    marked = ml.mark_split(rows.repartition(7), 0.75).collect()
    ordered = sorted(marked, key=lambda r: (r.city_id, r.year, r.month))
    assert [r.position for r in ordered] == list(range(1, len(ordered) + 1))
    cutoff = int(len(ordered) * 0.75)
    assert [r.is_train for r in ordered] == [True] * cutoff + [False] * (len(ordered) - cutoff)
    train, test = ml.ordered_split(rows, 0.75)
    assert (train.count(), test.count()) == (cutoff, len(ordered) - cutoff)


def test_time_split_cuts_between_months(rows):
    train, test = ml.ordered_split(rows, 0.5, mode="time")
    newest = train.agg(F.max("time_index")).first()[0]
    assert newest < test.agg(F.min("time_index")).first()[0]
    assert train.count() + test.count() == rows.count()


def test_split_drops_null_and_nan(spark, rows):
    broken = rows.withColumn(
        "delta_1m",
        F.when(F.col("month") == 1, F.lit(None)).when(F.col("month") == 2, float("nan")).otherwise(F.col("delta_1m")),
    )
    assert ml.mark_split(broken, 0.5).count() == rows.where("month > 2").count()


def test_rows_without_a_city_come_last(spark, rows):
    lost = rows.withColumn("city_id", F.when(F.col("city_id") != 1, F.col("city_id")))
    marked = ml.mark_split(lost, 0.5)
    assert marked.count() == rows.count()
    first = marked.where("city_id is null").agg(F.min("position")).first()[0]
    assert first == rows.where("city_id <> 1").count() + 1


@pytest.mark.parametrize("fraction", [0.0, 1.0, -1, 2])
def test_fraction_must_be_inside(rows, fraction):
    with pytest.raises(ValueError):
        ml.ordered_split(rows, fraction)


def test_split_errors(rows):
    with pytest.raises(ValueError, match="empty"):
        ml.ordered_split(rows.limit(1), 0.75)
    with pytest.raises(KeyError, match="delta_3m"):
        ml.ordered_split(rows.drop("delta_3m"), 0.75)
    with pytest.raises(ValueError, match="mode"):
        ml.ordered_split(rows, 0.5, mode="random")


def test_class_weights_balance(rows):
    weighted = ml.with_class_weights(rows)
    sums = [r[1] for r in weighted.groupBy(TARGET_COLUMN).agg(F.sum("class_weight")).collect()]
    assert sums == pytest.approx([rows.count() / 2] * 2)
    one = ml.with_class_weights(rows.where(f"{TARGET_COLUMN} = 1"))
    assert one.select("class_weight").distinct().collect()[0][0] == 1.0
    assert "Exchange hashpartitioning" not in weighted._jdf.queryExecution().optimizedPlan().toString()


def scored(spark, rows):
    return spark.createDataFrame(
        rows, f"{TARGET_COLUMN} int, {ml.PREDICTION} int, {ml.PROBABILITY} double"
    )


def test_report(spark):
    frame = scored(spark, [(0, 0, 0.1)] * 6 + [(0, 1, 0.6)] * 2 + [(1, 1, 0.9)] * 1 + [(1, 0, 0.2)] * 3)
    report = {r["class"]: r for r in ml.classification_report(frame).collect()}
    assert sorted(report) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert (report["0"].precision, report["0"].recall, report["0"].support) == (6 / 9, 6 / 8, 8)
    assert (report["1"].precision, report["1"].recall, report["1"].support) == (1 / 3, 1 / 4, 4)
    assert report["1"].f1 == pytest.approx(2 / 7)
    assert report["accuracy"].precision == pytest.approx(7 / 12)
    assert report["macro avg"].recall == pytest.approx((6 / 8 + 1 / 4) / 2)
    assert report["weighted avg"].recall == pytest.approx(7 / 12)


def test_report_zero_division_and_one_class(spark):
    never_called = scored(spark, [(0, 0, 0.1), (1, 0, 0.1)])
    report = {r["class"]: r for r in ml.classification_report(never_called).collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].f1) == (0.0, 0.0, 0.0)
    only_zero = scored(spark, [(0, 0, 0.1), (0, 0, 0.3)])
    report = {r["class"] for r in ml.classification_report(only_zero).collect()}
    assert "1" not in report
    record = ml.metrics_record(only_zero, only_zero).first()
    assert record.precision_1 != record.precision_1 and record.roc_auc is None
    assert record.accuracy == 1.0 and record.positive_class_ratio == 0.0 and record.test_size == 2


def brute_auc(rows):
    wins = [
        1.0 if p > q else 0.5 if p == q else 0.0
        for (a, p), (b, q) in itertools.product(rows, rows)
        if a == 1 and b == 0
    ]
    return sum(wins) / len(wins) if wins else None


@pytest.mark.parametrize("seed", range(4))
def test_auc_with_ties_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 1 + seed)) for _ in range(120)]
    frame = scored(spark, [(y, 0, p) for y, p in rows])
    assert ml.roc_auc(frame).first().roc_auc == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_of_one_class_and_of_one_score(spark):
    assert ml.roc_auc(scored(spark, [(1, 1, 0.5), (1, 0, 0.2)])).first().roc_auc is None
    assert ml.roc_auc(scored(spark, [(1, 1, 0.5), (0, 0, 0.5)])).first().roc_auc == 0.5


def test_forest_learns_and_survives_storage(spark, rows, tmp_path):
    train, test = ml.ordered_split(rows, 0.75)
    model = ml.train_forest(train, SMALL)
    path = str(tmp_path / "model")
    writers.save_model(model, path)
    loaded = writers.load_model(path)
    fresh = ml.score(test, model, keep=[TARGET_COLUMN])
    again = ml.score(test, loaded, keep=[TARGET_COLUMN])
    assert sorted(map(tuple, fresh.collect())) == sorted(map(tuple, again.collect()))
    assert ml.roc_auc(fresh).first().roc_auc > 0.95
    assert fresh.columns[:4] == ["city_id", "city_name", "year", "month"]
    with pytest.raises(FileNotFoundError):
        writers.load_model(str(tmp_path / "nothing"))


def test_scoring_threshold_includes_one_half(spark, rows):
    model = ml.train_forest(rows, SMALL)
    probabilities = ml.score(rows, model)
    value = probabilities.select(ml.PROBABILITY).first()[0]
    at = ml.score(rows, model, threshold=value).where(F.col(ml.PROBABILITY) == value)
    assert at.select(ml.PREDICTION).distinct().collect()[0][0] == 1
    with pytest.raises(KeyError):
        ml.score(rows.drop("sin_month"), model)


def test_probability_fallbacks(spark):
    margin = spark.createDataFrame([(0.0,), (2.0,)], "rawPrediction double")
    assert [r[0] for r in margin.select(ml.event_probability(None, margin)).collect()] == pytest.approx(
        [0.5, 0.8807970779778823]
    )
    hard = spark.createDataFrame([(1.0,)], "prediction double")
    assert hard.select(ml.event_probability(None, hard)).first()[0] == 1.0


def test_metrics_document(spark, tmp_path):
    frame = scored(spark, [(0, 0, 0.1)] * 3 + [(1, 1, 0.9)])
    document = ml.metrics_document(ml.metrics_record(frame, frame), frame)
    path = str(tmp_path / "metrics")
    writers.write_metrics_document(document, path)
    back = spark.read.json(path).first()
    assert back.feature_columns == list(FEATURE_COLUMNS) and back.roc_auc == 1.0
    assert {r["class"]: r.n for r in back.class_distribution_test} == {0: 3, 1: 1}
    assert len(back.classification_report) == 5
