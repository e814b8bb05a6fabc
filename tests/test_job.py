"""The whole job on documents of three cities: backfill, then a daily run with a correction."""

import json
import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from isotherm.config import DAILY_VARIABLES, ClimateConfig
from isotherm.operators import landing, quality
from isotherm.plans import job
from isotherm.schemas import ML_METRICS, RUN_LOG
from isotherm.sources import readers, writers

CONFIG = ClimateConfig(baseline_first_year=2016, baseline_last_year=2019, n_trees=4, max_depth=3)
CITIES = {1: "Oslo", 2: "New York", 3: "Lima"}


def put(root, name, year, last, seed=0):
    rng = random.Random(f"{name}{year}{seed}")
    days = [date(year, 1, 1) + timedelta(d) for d in range((last - date(year, 1, 1)).days + 1)]
    level = {m: rng.gauss(0, 2) for m in range(1, 13)}
    mean = [15 - 9 * math.cos(d.timetuple().tm_yday / 58) + level[d.month] + rng.gauss(0, 1) for d in days]
    daily = {"time": [d.isoformat() for d in days]}
    for variable in DAILY_VARIABLES:
        shift = {"temperature_2m_max": 5, "temperature_2m_min": -5}.get(variable, 0)
        daily[variable] = [abs(x) if "sum" in variable else x + shift for x in mean]
    folder = root / name.lower().replace(" ", "_")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{year}.json").write_text(json.dumps({"daily": daily}, indent=2))


@pytest.fixture(scope="module")
def where(tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    rows = [f"{i},{n},XX,0.0,0.0,UTC,a,b,1,f" for i, n in CITIES.items()]
    header = "city_id,city_name,country_code,latitude,longitude,timezone,admin1,admin2,population,raw_geocoding_file"
    (folder / "dim_city.csv").write_text("\n".join([header, *rows]))
    for name in CITIES.values():
        for year in range(2016, 2021):
            put(folder / "raw", name, year, date(year, 12, 31) if year < 2020 else date(2020, 9, 9))
    (folder / "raw" / "oslo" / "2015.json").write_text('{"daily": {"time": []}}')
    return folder, job.Locations(
        str(folder / "raw"), str(folder / "dim_city.csv"), str(folder / "warehouse")
    )


def test_backfill_then_daily(spark, where):
    folder, places = where
    predictions = job.run_job(spark, places, CONFIG, "backfill", as_of=date(2020, 9, 10))
    read = lambda name: spark.read.parquet(places.table(name))

    n_days = sum(366 if y == 2016 else 365 for y in range(2016, 2020)) + 253
    assert read("landing_daily_weather").count() == 3 * n_days
    assert [r.city_slug for r in read("quarantined_documents").collect()] == ["oslo"]
    assert read("clean_monthly_climate").count() == 3 * 57
    assert read("climatology_city_month").count() == 36
    assert read("anomaly_city_correlations").count() == 3
    assert read("anomaly_city_lags").count() == 3 * 2 * 13
    assert predictions.count() == read("ml_features").count() == 3 * 54
    assert read("check_results").where("not passed").count() == 0
    assert quality.contract_problems(read("pipeline_ml_metrics"), ML_METRICS) == []
    metrics = read("pipeline_ml_metrics").first()
    assert (metrics.id, metrics.train_size, metrics.test_size) == (1, 121, 41)
    assert metrics.run_mode == "backfill" and 0 <= metrics.accuracy <= 1
    assert spark.read.json(places.table("models/baseline_rf_metrics")).first().train_size == 121
    header = spark.read.option("header", True).csv(places.table("ml_predictions_csv"))
    assert header.columns == predictions.columns and header.count() == 3 * 54

    # a longer and corrected year of one city; older years are not read in daily mode
    put(folder / "raw", "Lima", 2020, date(2020, 9, 20), seed=1)
    put(folder / "raw", "Lima", 2018, date(2018, 1, 5), seed=1)
    old = read("clean_monthly_climate").where("year < 2020").collect()
    job.run_job(spark, places, CONFIG, "daily", as_of=date(2020, 9, 21), store_lags=False)
    assert read("landing_daily_weather").count() == 3 * n_days + 11
    assert sorted(old) == sorted(read("clean_monthly_climate").where("year < 2020").collect())
    september = read("clean_monthly_climate").where("city_id = 3 and year = 2020 and month = 9").first()
    assert september.days_in_month == 20

    # the backfill's quarantined document of another year is still there
    assert [r.city_slug for r in read("quarantined_documents").collect()] == ["oslo"]

    log = spark.read.schema(RUN_LOG).parquet(places.table("pipeline_run_log")).orderBy("id").collect()
    assert [(r.id, r.run_mode, r.status) for r in log] == [(1, "backfill", "success"), (2, "daily", "success")]
    assert (log[0].rows_bronze_delta, log[1].rows_bronze_delta) == (3 * n_days, 11)
    assert (log[1].bronze_max_date, log[1].gold_ml_max_date) == (date(2020, 9, 20), date(2020, 9, 1))
    assert log[1].freshness_status == "fresh"


def test_a_document_that_crosses_new_year_and_a_year_without_documents(spark, where, tmp_path):
    folder, places = where
    elsewhere = job.Locations(str(tmp_path / "raw"), places.dim_city, str(tmp_path / "warehouse"))
    for year in (2017, 2018):
        put(tmp_path / "raw", "Oslo", year, date(year, 12, 31) if year == 2018 else date(2017, 12, 30))
    job.land(spark, elsewhere, CONFIG)
    job.build_layers(spark, elsewhere, CONFIG, store_lags=False)
    month = lambda: spark.read.parquet(elsewhere.table("clean_monthly_climate")).where("year = 2017 and month = 12").first()
    assert month().days_in_month == 30

    late = json.loads((tmp_path / "raw" / "oslo" / "2018.json").read_text())["daily"]
    late = {k: [v[0], *v] for k, v in late.items()}
    late["time"][0] = "2017-12-31"
    (tmp_path / "raw" / "oslo" / "2019.json").write_text(json.dumps({"daily": late}))
    touched = job.land(spark, elsewhere, CONFIG, 2019)
    assert touched == [2017, 2018]
    job.build_layers(spark, elsewhere, CONFIG, touched, store_lags=False)
    assert month().days_in_month == 31

    assert job.land(spark, elsewhere, CONFIG, 2031) == []  # the first of January
    assert job.build_layers(spark, elsewhere, CONFIG, [], store_lags=False)["clean_monthly_climate"].count() == 24


def test_the_job_reads_a_landing_zone(spark, where, tmp_path):
    folder, places = where
    raw = readers.read_raw_daily(spark, places.raw, CONFIG.variables)
    documents = landing.with_city_slug(raw).select(
        "daily", "city_slug", F.regexp_extract("file_path", r"(\d+)\.json$", 1).cast("long").alias("year")
    )
    zone = job.Locations(str(tmp_path / "zone"), places.dim_city, str(tmp_path / "zoned"), zoned=True)
    plain = job.Locations(places.raw, places.dim_city, str(tmp_path / "plain"))
    writers.land_documents(documents, zone.raw, "backfill")
    assert job.land(spark, zone, CONFIG) == job.land(spark, plain, CONFIG) == list(range(2016, 2021))
    rows = lambda w: sorted(map(str, spark.read.parquet(w.table("landing_daily_weather")).collect()))
    assert rows(zone) == rows(plain)
    found = spark.read.parquet(zone.table("quarantined_documents")).collect()
    assert [(r.city_slug, r.file_year) for r in found] == [("oslo", 2015)]
    assert job.land(spark, zone, CONFIG, 2018) == [2018] and job.land(spark, zone, CONFIG, 2031) == []
    assert spark.read.parquet(zone.table("quarantined_documents")).count() == 1


def test_cities_that_share_a_slug_fail_the_checks(spark, where, tmp_path):
    _, places = where
    cities = spark.createDataFrame([(1, "Spring Field"), (2, "spring_field"), (3, "Lima")], "city_id long, city_name string")
    daily = spark.read.parquet(places.table("landing_daily_weather")).limit(5)
    here = job.Locations(places.raw, places.dim_city, str(tmp_path / "warehouse"))
    found = job.run_checks({"landing_daily_weather": daily}, here, dim_city=cities)
    assert found.where("table_name = 'dim_city'").first().n_failed == 1


def test_failed_checks_fail_the_run_and_are_logged(spark, where, tmp_path):
    _, places = where
    elsewhere = job.Locations(places.raw, places.dim_city, str(tmp_path / "warehouse"))
    (tmp_path / "cities.csv").write_text("city_id\n")
    nameless = job.Locations(places.raw, str(tmp_path / "cities.csv"), elsewhere.warehouse)
    with pytest.raises(job.ChecksFailed):
        job.run_job(spark, nameless, CONFIG, "backfill", as_of=date(2020, 9, 21))
    failed = spark.read.parquet(elsewhere.table("check_results")).where("not passed")
    assert "not_null(city_id)" in {r.rule for r in failed.collect()}
    log = spark.read.parquet(elsewhere.table("pipeline_run_log")).collect()
    assert [(r.status, r.run_mode) for r in log] == [("failed", "backfill")]
    with pytest.raises(ValueError):
        job.run_job(spark, elsewhere, CONFIG, "weekly")
