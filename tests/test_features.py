import math
import statistics

import pytest
from pyspark.sql import functions as F

from isotherm.config import FEATURE_COLUMNS
from isotherm.operators import features

SCHEMA = (
    "city_id long, city_name string, year long, month long, anomaly_tmean_c double,"
    "is_strong_positive_temp_anomaly boolean, is_strong_negative_temp_anomaly boolean"
)


def series(spark, months, city=1, hot=(), cold=()):
    rows = [(city, f"c{city}", 2000, m, float(m * m), m in hot, m in cold) for m in months]
    return spark.createDataFrame(rows, SCHEMA)


def by_month(frame):
    return {r.month: r for r in frame.collect()}


def test_frames_count_rows_across_a_gap(spark):
    rows = by_month(features.rolling_features(series(spark, [1, 2, 3, 4, 7, 8, 9])))
    assert rows[1].roll_mean_3 == 1.0 and rows[1].roll_std_3 is None and rows[1].delta_1m is None
    assert rows[7].roll_mean_3 == pytest.approx((9 + 16 + 49) / 3)
    assert rows[7].roll_std_3 == pytest.approx(statistics.stdev([9, 16, 49]))
    assert rows[9].roll_mean_6 == pytest.approx((4 + 9 + 16 + 49 + 64 + 81) / 6)
    assert rows[7].delta_1m == 49 - 16 and rows[7].delta_3m == 49 - 4
    assert rows[3].delta_3m is None and rows[4].delta_3m == 16 - 1


def test_label_follows_the_calendar(spark):
    rolled = features.rolling_features(series(spark, [1, 2, 3, 4, 7, 8], hot=[2, 7], cold=[8]))
    labels = {m: r.is_event_next_month for m, r in by_month(features.next_month_label(rolled)).items()}
    # month 7 is an event, but April is not the month before it
    assert labels == {1: 1, 2: 0, 3: 0, 4: 0, 7: 1, 8: 0}
    kept = by_month(features.next_month_label(rolled, drop_unlabelled=True))
    assert sorted(kept) == [1, 2, 3, 7]


def test_label_equals_self_join(spark):
    frame = series(spark, [1, 2, 4, 5, 6, 9, 10, 12], hot=[2, 6, 10], cold=[5]).unionByName(
        series(spark, range(1, 13), city=2, hot=[1, 12])
    )
    rolled = features.rolling_features(frame)
    strong = F.col("is_strong_positive_temp_anomaly") | F.col("is_strong_negative_temp_anomaly")
    ahead = rolled.select("city_id", (F.col("time_index") - 1).alias("time_index"), strong.alias("s"))
    joined = rolled.join(ahead, ["city_id", "time_index"], "left").select(
        "city_id", "month", F.coalesce(F.col("s").cast("int"), F.lit(0))
    )
    labelled = features.next_month_label(rolled).select("city_id", "month", "is_event_next_month")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, labelled.collect()))


def test_ml_features_are_complete(spark):
    frame = series(spark, range(1, 13), hot=[6]).unionByName(series(spark, range(1, 13), city=2))
    links = spark.createDataFrame([(1, 0.5, -2)], "city_id long, max_lagged_corr double, lead_lag_months long")
    rows = features.ml_features(frame, links).orderBy("month").collect()
    # city 2 has no link; the first three months of city 1 have no delta_3m
    assert [(r.city_id, r.month) for r in rows] == [(1, m) for m in range(4, 13)]
    assert [r.is_event_next_month for r in rows] == [0, 1] + [0] * 7
    assert rows[0].sin_month == pytest.approx(math.sin(2 * math.pi * 4 / 12))
    assert all(r[c] is not None for r in rows for c in FEATURE_COLUMNS)
    assert len(rows[0]) == 16


def test_all_windows_share_one_shuffle(spark):
    frame = series(spark, range(1, 13)).repartition(3)
    labelled = features.next_month_label(features.rolling_features(frame))
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
