from datetime import date

import pytest

from isotherm.operators import windows


@pytest.fixture
def cities(spark):
    return spark.createDataFrame([(1, "Oslo"), (2, "New York")], "city_id long, city_name string")


def plan(frame):
    return sorted((r.city_id, r.year, str(r.window_start), str(r.window_end)) for r in frame.collect())


def test_backfill_clamps_and_skips(spark, cities):
    landed = spark.createDataFrame([("oslo", 2020), ("new_york", 2019)], "city_slug string, year long")
    found = windows.plan_windows(cities, "backfill", landed, date(2019, 6, 15), date(2020, 1, 10))
    assert plan(found) == [
        (1, 2019, "2019-06-15", "2019-12-31"),
        (2, 2020, "2020-01-01", "2020-01-10"),
    ]
    everything = spark.createDataFrame(
        [(s, y) for s in ("oslo", "new_york") for y in (2019, 2020)], "city_slug string, year long"
    )
    assert windows.plan_windows(cities, "backfill", everything, date(2019, 6, 15), date(2020, 1, 10)).count() == 0


def test_one_day_and_two_years(cities):
    day = date(2020, 2, 29)
    assert plan(windows.plan_windows(cities, "backfill", None, day, day))[0] == (1, 2020, str(day), str(day))
    over = windows.plan_windows(cities, "backfill", None, date(2019, 12, 31), date(2020, 1, 1))
    assert plan(over)[:2] == [
        (1, 2019, "2019-12-31", "2019-12-31"),
        (1, 2020, "2020-01-01", "2020-01-01"),
    ]


def test_default_window(cities):
    assert windows.plan_windows(cities, "backfill").count() == 2 * 45


def test_errors(cities):
    with pytest.raises(ValueError, match="after"):
        windows.plan_windows(cities, "backfill", None, date(2020, 1, 2), date(2020, 1, 1))
    with pytest.raises(ValueError):
        windows.plan_windows(cities, "recent")
    with pytest.raises(ValueError):
        windows.plan_windows(cities, "other", windows.plan_windows(cities, "backfill"))


def test_recent(cities):
    assert windows.plan_windows(cities, "recent", as_of=date(2024, 1, 1)).count() == 0
    assert plan(windows.plan_windows(cities, "recent", as_of=date(2024, 1, 2)))[0] == (
        1, 2024, "2024-01-01", "2024-01-01",
    )
    assert plan(windows.plan_windows(cities, "recent", as_of=date(2024, 12, 31)))[0][3] == "2024-12-30"


def test_coverage_finds_the_missing_day(spark, cities):
    days = [("oslo", date(2020, 12, d)) for d in range(1, 31)] + [("oslo", date(2020, 12, 1))]
    landed = spark.createDataFrame(days, "city_slug string, date date")
    found = windows.plan_windows(cities, "coverage", landed, date(2020, 12, 1), date(2020, 12, 31))
    assert [row[0] for row in plan(found)] == [1, 2]
    complete = landed.union(spark.createDataFrame([("oslo", date(2020, 12, 31))], landed.schema))
    found = windows.plan_windows(cities, "coverage", complete, date(2020, 12, 1), date(2020, 12, 31))
    assert [r.city_id for r in found.collect()] == [2]


def test_attempts(spark):
    schema = "city_name string, succeeded boolean"
    some = spark.createDataFrame([("b", False), ("a", False), ("b", False), ("c", True)], schema)
    row = windows.landed_summary(some, "recent").first()
    assert (row.mode, row.total_cities, row.total_requests, row.successes, row.failures) == ("recent", 3, 4, 1, 3)
    assert (row.n_failed_cities, row.run_failed) == (2, False)
    fleet = spark.range(7).withColumnRenamed("id", "city_id")
    assert windows.landed_summary(some, "recent", fleet).first().total_cities == 7
    assert [tuple(r) for r in windows.failed_cities(some).collect()] == [("a", 1), ("b", 2)]
    assert windows.landed_summary(some.where("not succeeded"), "recent").first().run_failed
    assert windows.landed_summary(some.limit(0), "recent").first().run_failed
