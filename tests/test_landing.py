import json
from datetime import date

import re

import pytest
from pyspark.sql import functions as F

from isotherm.config import DAILY_VARIABLES
from isotherm.operators import landing
from isotherm.sources import readers, writers
from isotherm.streaming.landing import stream_landed_documents, stream_landing


def document(days, value=1.0, **overrides):
    daily = {"time": days, **{v: [value] * len(days) for v in DAILY_VARIABLES}, **overrides}
    return {"latitude": 1.5, "daily": {k: v for k, v in daily.items() if v != "absent"}}


def put(root, slug, name, content):
    folder = root / slug
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content, indent=2)
    (folder / f"{name}.json").write_text(text, encoding="utf-8")


@pytest.fixture
def dim(spark):
    rows = [(1, "Oslo", "NO"), (2, "New York", "US")]
    return spark.createDataFrame(rows, "city_id long, city_name string, country_code string")


def test_validation_of_files(spark, tmp_path):
    days = ["2020-01-01", "2020-01-02"]
    put(tmp_path, "good", 2020, document(days))
    put(tmp_path, "nodaily", 2020, {"latitude": 3})
    put(tmp_path, "notime", 2020, document(days, time="absent"))
    put(tmp_path, "empty", 2020, document([]))
    put(tmp_path, "lacks", 2020, document(days, precipitation_sum="absent"))
    put(tmp_path, "short", 2020, document(days, precipitation_sum=[1.0]))
    put(tmp_path, "long", 2020, document(days, precipitation_sum=[1.0, 2.0, 3.0]))
    put(tmp_path, "baddate", 2020, document(["2020-01-01", "soon"]))
    put(tmp_path, "broken", 2020, "{ not json")
    checked = landing.validate_raw(landing.with_city_slug(readers.read_raw_daily(spark, str(tmp_path))))
    found = {r.city_slug: (r.n_records, r.errors) for r in checked.collect()}
    assert found["good"] == (2, [])
    assert found["nodaily"] == (0, ["missing daily"])
    assert found["notime"] == (0, ["missing daily.time"])
    assert found["empty"] == (0, ["empty daily.time"])
    assert found["lacks"] == (2, ["missing daily.precipitation_sum"])
    assert found["short"] == (2, ["length of daily.precipitation_sum: expected 2, got 1"])
    assert found["long"] == (2, ["length of daily.precipitation_sum: expected 2, got 3"])
    assert found["baddate"] == (2, ["bad daily.time"])
    assert "unreadable document" in found["broken"][1]
    good, bad = landing.split_valid(checked)
    assert (good.count(), bad.count()) == (1, 8)


def test_flatten_follows_time(spark, tmp_path):
    days = ["2020-01-01", "2020-01-02", "2020-01-03"]
    put(
        tmp_path,
        "new york",
        2020,
        document(
            days,
            temperature_2m_max=[1.0, None, 3.0],
            temperature_2m_min=[9.0],
            dew_point_2m_mean=[1.0, 2.0, 3.0, 4.0],
            precipitation_sum="absent",
        ),
    )
    flat = landing.flatten_daily(readers.read_raw_daily(spark, str(tmp_path)))
    rows = flat.orderBy("date").collect()
    assert [r.date for r in rows] == [date(2020, 1, d) for d in (1, 2, 3)]
    assert {r.city_slug for r in rows} == {"new york"}
    assert [r.year for r in rows] == [2020] * 3
    assert [r.temperature_2m_max for r in rows] == [1.0, None, 3.0]
    assert [r.temperature_2m_min for r in rows] == [9.0, None, None]
    assert [r.dew_point_2m_mean for r in rows] == [1.0, 2.0, 3.0]
    assert [r.precipitation_sum for r in rows] == [None] * 3


def test_year_argument_limits_the_files(spark, tmp_path):
    put(tmp_path, "oslo", 2019, document(["2019-05-01"]))
    put(tmp_path, "oslo", 2020, document(["2020-05-01"]))
    flat = landing.flatten_daily(readers.read_raw_daily(spark, str(tmp_path), year=2020))
    assert [r.date for r in flat.collect()] == [date(2020, 5, 1)]


def test_unknown_city_survives(spark, tmp_path, dim):
    put(tmp_path, "new_york", 2020, document(["2020-01-01"]))
    put(tmp_path, "atlantis", 2020, document(["2020-01-01"]))
    put(tmp_path, "eldorado", 2020, document(["2020-01-01"]))
    days = landing.attach_city(
        landing.flatten_daily(readers.read_raw_daily(spark, str(tmp_path))), dim
    )
    assert {r.city_slug: r.city_id for r in days.collect()} == {
        "new_york": 2, "atlantis": None, "eldorado": None,
    }
    # two unknown cities on one day are two rows, not one key
    assert landing.land_incremental(days, None).count() == 3


def daily(spark, *rows):
    return spark.createDataFrame(
        [(i, f"c{i}", date.fromisoformat(d), int(d[:4]), x, n) for i, d, x, n in rows],
        "city_id long, city_slug string, date date, year long, value double, version int",
    )


def content(frame):
    return sorted((r.city_id, str(r.date), r.value) for r in frame.collect())


def test_high_watermark_is_global(spark):
    target = daily(spark, (1, "2020-01-05", 1.0, 1)).drop("version")
    new = daily(
        spark,
        (1, "2020-01-05", 9.0, 1),
        (1, "2020-01-06", 2.0, 1),
        (2, "2020-01-01", 3.0, 1),
        (2, "2020-01-07", 4.0, 1),
    ).drop("version")
    loaded = landing.land_incremental(new, target, mode="high_watermark")
    expected = [(1, "2020-01-05", 1.0), (1, "2020-01-06", 2.0), (2, "2020-01-07", 4.0)]
    assert content(loaded) == expected
    again = landing.land_incremental(new, loaded, mode="high_watermark")
    assert content(again) == expected
    # an existing but empty target never loads, an absent one takes all
    assert landing.land_incremental(new, target.limit(0), mode="high_watermark").count() == 0
    assert landing.land_incremental(new, None, mode="high_watermark").count() == 4


def test_upsert_takes_late_days_and_the_newest_version(spark):
    target = daily(spark, (1, "2020-01-05", 1.0, 1), (1, "2020-01-04", 5.0, 1)).drop("version")
    new = daily(
        spark,
        (1, "2020-01-05", 7.0, 1),
        (1, "2020-01-05", 8.0, 2),
        (2, "2019-12-31", 3.0, 1),
    )
    loaded = landing.land_incremental(new, target, order_by="version")
    expected = [(1, "2020-01-04", 5.0), (1, "2020-01-05", 8.0), (2, "2019-12-31", 3.0)]
    assert content(loaded) == expected
    assert content(landing.land_incremental(new, loaded, order_by="version")) == expected
    # order of delivery does not matter
    reversed_new = new.orderBy(F.col("version").desc())
    assert content(landing.land_incremental(reversed_new, target, order_by="version")) == expected
    with pytest.raises(ValueError):
        landing.land_incremental(new, target, mode="replace")


def test_city_that_becomes_known_leaves_no_copy(spark):
    days = daily(spark, (1, "2020-01-05", 1.0, 1), (1, "2020-01-06", 2.0, 1)).drop("version")
    unknown = days.withColumn("city_id", F.lit(None).cast("long"))
    other = daily(spark, (2, "2020-01-05", 9.0, 1)).drop("version")
    stored = unknown.union(other)
    loaded = landing.land_incremental(days.where("value = 1"), stored)
    found = {(r.city_id, r.city_slug, str(r.date)) for r in loaded.collect()}
    assert found == {(1, "c1", "2020-01-05"), (None, "c1", "2020-01-06"), (2, "c2", "2020-01-05")}
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan


def test_stored_load_touches_only_its_years(spark, tmp_path):
    path = str(tmp_path / "daily")
    writers.load_daily(
        daily(spark, (1, "2019-06-01", 1.0, 1), (1, "2020-06-01", 2.0, 1)), path, order_by="version"
    )
    files_2019 = {f.name for f in (tmp_path / "daily" / "year=2019").glob("*.parquet")}
    loaded = writers.load_daily(
        daily(spark, (1, "2020-06-01", 9.0, 1), (1, "2020-06-02", 3.0, 1)), path, order_by="version"
    )
    assert content(loaded) == [
        (1, "2019-06-01", 1.0), (1, "2020-06-01", 9.0), (1, "2020-06-02", 3.0),
    ]
    assert {f.name for f in (tmp_path / "daily" / "year=2019").glob("*.parquet")} == files_2019
    late = daily(spark, (1, "2020-05-01", 0.0, 1), (1, "2021-01-01", 4.0, 1))
    loaded = writers.load_daily(late, path, mode="high_watermark", order_by="version")
    assert content(loaded)[-1] == (1, "2021-01-01", 4.0) and loaded.count() == 4
    with pytest.raises(ValueError):
        writers.load_daily(late, path, mode="replace")


def test_stored_load_reads_only_its_years(spark, tmp_path):
    path = str(tmp_path / "daily")
    days = daily(spark, *[(1, f"{y}-06-01", 1.0, 1) for y in range(2000, 2021)])
    assert writers.upsert_daily(days, path, order_by="version") == list(range(2000, 2021))
    assert writers.upsert_daily(days.where("year = 2003"), path, order_by="version") == [2003]
    plan = writers.of_years(spark.read.parquet(path), [2003])._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "2003" in filters
    assert writers.of_years(spark.read.parquet(path), [2003, None]).count() == 1


def test_ties_of_the_load_order_go_by_content(spark):
    rows = [(1, "2020-01-01", float(x), 1) for x in range(20)]
    found = {
        content(landing.newest_per_key(daily(spark, *order).repartition(n), order_by="version"))[0]
        for order in (rows, rows[::-1])
        for n in (1, 4)
    }
    assert len(found) == 1


def landed(spark, *rows):
    documents = [({"time": [f"{y}-01-01"], "temperature_2m_max": [x]}, slug, y) for slug, y, x in rows]
    return spark.createDataFrame(
        documents,
        "daily struct<time:array<string>,temperature_2m_max:array<double>>, city_slug string, year long",
    )


def test_landing_zone_skip_and_replace(spark, tmp_path):
    zone = str(tmp_path / "zone")
    writers.land_documents(landed(spark, ("oslo", 2019, 1.0)), zone, "backfill")
    writers.land_documents(
        landed(spark, ("oslo", 2019, 5.0), ("são paulo", 2020, 2.0)), zone, "backfill"
    )

    def highs():
        documents = readers.read_landed_documents(spark, zone, ["temperature_2m_max"])
        flat = landing.flatten_daily(documents, ["temperature_2m_max"])
        return {(r.city_slug, r.year): r.temperature_2m_max for r in flat.collect()}

    assert highs() == {("oslo", 2019): 1.0, ("são paulo", 2020): 2.0}
    writers.land_documents(landed(spark, ("são paulo", 2020, 7.0)), zone, "recent")
    assert highs() == {("oslo", 2019): 1.0, ("são paulo", 2020): 7.0}
    windows = readers.landed_windows(spark, zone, partitioned=True)
    assert {tuple(r) for r in windows.collect()} == {("oslo", 2019), ("são paulo", 2020)}
    with pytest.raises(ValueError):
        writers.land_documents(landed(spark), zone, "other")


def test_landed_windows_of_plain_files(spark, tmp_path):
    put(tmp_path, "são paulo", 2020, document(["2020-01-01"]))
    windows = readers.landed_windows(spark, str(tmp_path))
    assert [tuple(r) for r in windows.collect()] == [("são paulo", 2020)]
    assert readers.landed_windows(spark, str(tmp_path / "nowhere")).count() == 0


def test_stream_landing(spark, tmp_path, dim):
    raw = tmp_path / "raw"

    def run():
        stream_landing(
            spark, str(raw), dim, str(tmp_path / "daily"), str(tmp_path / "bad"),
            str(tmp_path / "checkpoint"),
        ).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "daily")).collect()
        return {(r.city_id, str(r.date)): r.temperature_2m_max for r in rows}

    put(raw, "oslo", 2020, document(["2020-01-01", "2020-01-02"]))
    put(raw, "new_york", 2020, {"latitude": 1})
    assert run() == {(1, "2020-01-01"): 1.0, (1, "2020-01-02"): 1.0}
    assert spark.read.parquet(str(tmp_path / "bad")).select("city_slug").first()[0] == "new_york"
    # a late year and a correction under a new name; files seen before are not read again
    put(raw, "oslo", 2019, document(["2019-12-31"], 3.0))
    put(raw, "oslo", "2020-rev1", document(["2020-01-02"], 8.0))
    assert run() == {(1, "2020-01-01"): 1.0, (1, "2020-01-02"): 8.0, (1, "2019-12-31"): 3.0}
    assert len(run()) == 3


def test_stream_over_the_partitioned_zone(spark, tmp_path, dim):
    zone = str(tmp_path / "zone")
    put(tmp_path / "raw", "oslo", 2020, document(["2020-01-01"]))
    raw = landing.with_city_slug(readers.read_raw_daily(spark, str(tmp_path / "raw")))
    documents = raw.select("daily", "city_slug", F.lit(2020).cast("long").alias("year"))
    writers.land_documents(documents, zone, "backfill")
    stream_landed_documents(
        spark, zone, dim, str(tmp_path / "daily"), str(tmp_path / "bad"), str(tmp_path / "check")
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "daily")).count() == 1


def test_build_dim_city(spark, tmp_path):
    folder = tmp_path / "geo"
    folder.mkdir()
    hit = {"name": "Christiania", "country_code": "NO", "latitude": 38.7, "longitude": -9.1,
           "timezone": "Europe/Oslo", "population": 5}
    (folder / "1_oslo.json").write_text(json.dumps({"results": [hit, {"name": "other", "latitude": 0.0}]}))
    (folder / "2_new_york.json").write_text(json.dumps({"latitude": 40.7, "longitude": -74.0}, indent=1))
    (folder / "3_nowhere.json").write_text(json.dumps({"results": []}))
    cities = tmp_path / "cities.csv"
    cities.write_text("city_id,name,country_code\n1,Oslo,NO\n2,New York,US\n3,Nowhere,XX\n")
    dim = readers.build_dim_city(
        readers.read_geocoding(spark, str(folder)), readers.read_configured_cities(spark, str(cities))
    )
    rows = {r.city_id: r for r in dim.collect()}
    assert sorted(rows) == [1, 2]
    assert (rows[1].city_name, rows[1].country_code, rows[1].population) == ("Christiania", "NO", 5)
    assert (rows[2].city_name, rows[2].country_code, rows[2].latitude) == ("New York", "US", 40.7)
    assert rows[1].raw_geocoding_file.endswith("1_oslo.json")
    assert len(dim.columns) == 10
