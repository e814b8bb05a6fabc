"""Runs that die after each step, runs with nothing to do, stored correlation sums, and the plan of missing days."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from test_job import CONFIG, put

from isotherm.operators import telecon
from isotherm.plans import job
from isotherm.sources.ledger import Ledger, content_fingerprint

CITIES = {1: "Oslo", 2: "New York", 3: "Lima"}
TABLES = ("clean_monthly_climate", "climatology_city_month", "anomaly_city_month", "anomaly_city_events",
          "anomaly_city_correlations", "anomaly_city_lags", "ml_features", "ml_predictions", "landing_daily_weather")


class Killed(RuntimeError):
    pass


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    place = tmp_path_factory.mktemp("resume")
    header = "city_id,city_name,country_code,latitude,longitude,timezone,admin1,admin2,population,raw_geocoding_file"
    rows = [f"{i},{n},XX,0.0,0.0,UTC,a,b,1,f" for i, n in CITIES.items()]
    (place / "dim_city.csv").write_text("\n".join([header, *rows]))
    for name in CITIES.values():
        for year in range(2016, 2020):
            put(place / "raw", name, year, date(year, 12, 31) if year < 2019 else date(2019, 9, 9))
    return place


def locations(folder, name):
    return job.Locations(str(folder / "raw"), str(folder / "dim_city.csv"), str(folder / name))


def contents(spark, places, tables=TABLES):
    def rounded(frame):
        doubles = {c for c, t in frame.dtypes if t == "double"}
        return frame.select(*[F.round(c, 9).alias(c) if c in doubles else F.col(c) for c in sorted(frame.columns)])

    return {t: sorted(map(str, rounded(spark.read.parquet(places.table(t))).collect())) for t in tables}


def test_a_run_that_dies_after_every_step_ends_like_a_clean_one(spark, folder):
    places, clean = locations(folder, "killed"), locations(folder, "clean")
    as_of, done = date(2019, 9, 10), []

    def kill(step):
        done.append(step)
        raise Killed(step)

    for _ in range(20):
        try:
            job.run_job(spark, places, CONFIG, "backfill", as_of=as_of, after_step=kill)
            break
        except Killed:
            pass
    assert done == ["land", "clean_monthly_climate", "climatology_city_month", "anomaly_city_month", "anomaly_city_events",
                    "anomaly_city_correlations", "anomaly_city_lags", "ml_features", "checks", "train"]
    job.run_job(spark, clean, CONFIG, "backfill", as_of=as_of)
    assert contents(spark, places) == contents(spark, clean)
    again = []
    job.run_job(spark, places, CONFIG, "backfill", as_of=as_of, after_step=again.append)
    assert again == []  # nothing has changed
    log = spark.read.parquet(places.table("pipeline_run_log")).orderBy("id").collect()
    assert [r.status for r in log] == ["failed"] * 10 + ["success"] * 2

    # new days: every step behind the landing is due, and the sums of the correlations take the new months alone
    put(folder / "raw", "Lima", 2019, date(2019, 11, 20), seed=4)
    for _ in range(2):
        job.run_job(spark, places, CONFIG, "daily", as_of=date(2019, 11, 21), after_step=again.append)
    assert again[0] == "land" and again[-1] == "train" and len(again) == len(set(again)) == 11
    anomaly = spark.read.parquet(places.table("anomaly_city_month"))
    found = spark.read.parquet(places.table("anomaly_city_lags"))
    key = ["city_id", "other_city_id", "lag_months"]
    full = {tuple(r[k] for k in key): r for r in telecon.lag_correlations(anomaly, CONFIG).collect()}
    rows = found.collect()
    assert {tuple(r[k] for k in key) for r in rows} == set(full)
    assert all(abs(r.anomaly_correlation - full[tuple(r[k] for k in key)].anomaly_correlation) < 1e-9 for r in rows)
    assert all(r.n_observations == full[tuple(r[k] for k in key)].n_observations for r in rows)


def test_coverage_reads_the_planned_documents_alone(spark, folder, tmp_path):
    places = job.Locations(str(tmp_path / "raw"), str(folder / "dim_city.csv"), str(tmp_path / "warehouse"))
    config = job.ClimateConfig(start_date=date(2017, 1, 1), end_date=date(2018, 12, 31))
    put(tmp_path / "raw", "Oslo", 2017, date(2017, 12, 31))
    put(tmp_path / "raw", "Oslo", 2018, date(2018, 3, 31))
    put(tmp_path / "raw", "Lima", 2017, date(2017, 12, 31))
    assert job.land_missing(spark, places, config, date(2019, 5, 1)) == [2017, 2018]
    plan = lambda: sorted((r.city_slug, r.window_start, r.window_end, r.missing_days) for r in spark.read.parquet(places.table("window_plan")).collect())
    whole = [("new_york", date(y, 1, 1), date(y, 12, 31), 365) for y in (2017, 2018)]
    assert plan() == sorted([("oslo", date(2018, 4, 1), date(2018, 12, 31), 275), ("lima", date(2018, 1, 1), date(2018, 12, 31), 365), *whole])

    # a landed year is complete: its changed document is not opened; the others are
    put(tmp_path / "raw", "Oslo", 2017, date(2017, 12, 31), seed=9)
    put(tmp_path / "raw", "Oslo", 2018, date(2018, 12, 31))
    (tmp_path / "raw" / "lima" / "2018.json").write_text("{")
    before = spark.read.parquet(places.table("landing_daily_weather")).where("year = 2017").collect()
    assert job.land_missing(spark, places, config, date(2019, 5, 1)) == [2018]
    assert sorted(before) == sorted(spark.read.parquet(places.table("landing_daily_weather")).where("year = 2017").collect())
    assert plan() == sorted([("lima", date(2018, 1, 1), date(2018, 12, 31), 365), *whole])
    assert [r.city_slug for r in spark.read.parquet(places.table("quarantined_documents")).collect()] == ["lima"]


def test_ledger(spark, tmp_path):
    runs = []
    step = lambda ledger, name, inputs, present=True: ledger.step(name, inputs, lambda: runs.append(name) or len(runs), lambda: present)
    first = Ledger(spark, str(tmp_path / "ledger"))
    assert step(first, "a", {"x": 1}) == 1 and step(first, "b", {"after": first.tokens("a")}) == 2
    second = Ledger(spark, str(tmp_path / "ledger"))
    assert step(second, "a", {"x": 1}) == 1 and step(second, "b", {"after": second.tokens("a")}) == 2
    assert runs == ["a", "b"] and second.ran == []
    assert step(second, "a", {"x": 2}) == 3 and step(second, "b", {"after": second.tokens("a")}) == 4
    assert step(second, "b", {"after": second.tokens("a")}, present=False) == 5
    frame = spark.createDataFrame([("a", None), ("b", None)], "file_path string, modified_at timestamp")
    assert content_fingerprint(frame) == content_fingerprint(frame.orderBy(F.desc("file_path")))
    assert content_fingerprint(frame) != content_fingerprint(frame.where("file_path = 'a'"))
