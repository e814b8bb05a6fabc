"""Schema drift of raw documents, AUC from sketches, windows of missing days, tables replaced at once."""

import json
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from isotherm.operators import auc_trend, drift, ml, windows
from isotherm.sources import writers


def test_unknown_and_retyped_parts_are_counted(spark):
    daily = {"time": ["2000-01-01"], "temperature_2m_max": [1.5], "precipitation_sum": [1]}
    docs = [
        ("a", {"daily": daily}),
        ("a", {"daily": {**daily, "snow": [1]}, "units": {"x": 1}}),
        ("a", {"daily": {**daily, "snow": None}}),
        ("b", {"daily": {**daily, "temperature_2m_max": ["1.5"], "precipitation_sum": [None, 2.5]}}),
        ("b", {"daily": [1]}),
        ("b", {"daily": {**daily, "time": [20000101]}}),
        ("b", {"daily": {**daily, "temperature_2m_max": [[1]]}}),
        ("c", [1]),
        ("c", {}),
    ]
    rows = [(s, 2000, json.dumps(d)) for s, d in docs] + [("c", 2001, "{not json"), ("c", 2001, None)]
    frame = spark.createDataFrame(rows, "city_slug string, year int, document string")
    found = sorted(tuple(r) for r in drift.drift_report(frame).collect())
    assert found == [
        ("a", "$.daily.snow", "unknown", 2),
        ("a", "$.units", "unknown", 1),
        ("b", "$.daily", "retyped", 1),
        ("b", "$.daily.temperature_2m_max", "retyped", 2),
        ("b", "$.daily.time", "retyped", 1),
        ("c", "$", "unreadable", 3),
    ]
    assert drift.drift_report(frame.limit(0)).count() == 0


def test_the_area_is_within_its_bound_and_sketches_merge(spark):
    rng = random.Random(1)
    rows = []
    for day in range(6):
        for _ in range(4000 if day < 4 else 3):
            hit = rng.random() < 0.2 and day != 5
            score = round(min(1.0, max(0.0, rng.gauss(0.6 if hit else 0.4, 0.2))), 3 if day % 2 else 1)  # ties
            rows.append((day, day // 2, int(hit), score))
    rows += [(0, 0, None, 0.5), (0, 0, 1, None)]
    frame = spark.createDataFrame(rows, "day int, week int, is_event_next_month int, prob_event_next_month double")
    days = auc_trend.score_sketches(frame, ["day", "week"])
    for by, sketches in (("day", days), ("week", auc_trend.merged_sketches(days, ["week"]))):
        for r in auc_trend.auc_trend(sketches).collect():
            exact = ml.roc_auc(frame.where(F.col(by) == r[by])).first()
            assert (r.n_positive, r.n_negative) == (exact.n_positive, exact.n_negative)
            if exact.roc_auc is None:
                assert r.roc_auc is None and r.error_bound is None
            else:
                assert abs(r.roc_auc - exact.roc_auc) <= r.error_bound < 0.02
    assert auc_trend.auc_trend(auc_trend.score_sketches(frame.limit(0), ["day"])).count() == 0


def plain_windows(missing, merge_days):
    out = []
    for day in sorted(missing):
        if out and out[-1][1].year == day.year and (day - out[-1][1]).days - 1 <= merge_days:
            out[-1] = (out[-1][0], day, out[-1][2] + 1)
        else:
            out.append((day, day, 1))
    return out


def test_missing_days_become_the_fewest_windows(spark):
    rng = random.Random(2)
    start, end = date(2000, 12, 20), date(2003, 1, 10)
    calendar = [start + timedelta(d) for d in range((end - start).days + 1)]
    cities = spark.createDataFrame([(1, "All"), (2, "None"), (3, "Some Where"), (4, "Twice")], "city_id long, city_name string")
    kept = {"all": set(calendar), "some_where": {d for d in calendar if rng.random() < 0.9}, "twice": {d for d in calendar if rng.random() < 0.5}}
    rows = [(slug, d) for slug, days in kept.items() for d in days] + [("twice", d) for d in kept["twice"]] + [("other", start), ("all", date(1999, 1, 1))]
    landed = spark.createDataFrame(rows, "city_slug string, date date")
    for merge_days in (0, 4):
        found = windows.missing_windows(cities, landed, start, end, merge_days).collect()
        assert all(r.year == r.window_start.year == r.window_end.year for r in found)
        for slug in ("all", "none", "some_where", "twice"):
            expected = plain_windows(set(calendar) - kept.get(slug, set()), merge_days)
            assert sorted((r.window_start, r.window_end, r.missing_days) for r in found if r.city_slug == slug) == expected


def test_a_table_is_replaced_when_the_new_one_is_complete(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.write_table(spark.range(10), path)
    doubled = spark.read.parquet(path).select((F.col("id") * 2).alias("id"))  # reads what it replaces
    assert sorted(r.id for r in writers.write_table(doubled, path).collect()) == list(range(0, 20, 2))
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).alias("id"))
    try:
        writers.write_table(broken, path)
    except Exception as problem:  # noqa: BLE001
        assert "broken" in str(problem)
    assert spark.read.parquet(path).count() == 10
    assert [p.name for p in tmp_path.iterdir() if "_old" in p.name] == []
