"""The landing zone as a data source: listing, reading, rewritten files in a stream, keyed deliveries."""

import json
import os
from datetime import date, datetime, timedelta

import pandas as pd
import pytest

from isotherm.config import DAILY_VARIABLES
from isotherm.operators import landing
from isotherm.sources import readers, zone
from isotherm.streaming import keyed


def document(days, value=1.0, **extra):
    daily = {"time": [d.isoformat() for d in days], **{v: [value] * len(days) for v in DAILY_VARIABLES}, **extra}
    return json.dumps({"daily": daily}, indent=1)


def put(root, slug, year, text):
    folder = root / slug
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{year}.json").write_text(text)


def days_of(year, count):
    return [date(year, 1, 1) + timedelta(d) for d in range(count)]


@pytest.fixture
def root(tmp_path):
    place = tmp_path / "raw"
    for n in range(30):
        put(place, f"city {n}", 2000 + n % 2, document(days_of(2000 + n % 2, 5)))
    put(place, "city 3", "notes", "{}")
    put(place, "broken", 2001, '{"daily": [')
    put(place, "_hidden", 2001, document(days_of(2001, 2)))
    (place / "city 4" / "_part.json").write_text("{}")
    (place / "city 4" / "readme.txt").write_text("x")
    return place


@pytest.mark.parametrize("shares", [1, 7, 64])
def test_listing_and_documents_equal_the_file_source(spark, root, shares):
    listed = zone.list_documents(spark, f"file:{root}", shares)
    assert listed.columns == ["city_slug", "year", "file_path", "modified_at"]
    names = sorted((r.city_slug, r.year) for r in listed.collect() if r.year)
    assert names == sorted([(f"city {n}", 2000 + n % 2) for n in range(30)] + [("broken", 2001)])
    assert listed.where("year is null").count() == 1  # notes.json

    read = zone.read_documents(spark, str(root), shares=shares)
    plain = landing.with_city_slug(readers.read_raw_daily(spark, str(root))).where("city_slug <> '_hidden'")
    days = lambda f: sorted(map(str, landing.flatten_daily(landing.split_valid(landing.validate_raw(f))[0]).drop("modified_at").collect()))
    assert days(read) == days(plain) and len(days(read)) == 150
    errors = {r.city_slug: r.errors for r in landing.split_valid(landing.validate_raw(read))[1].collect()}
    assert errors["broken"][0] == "unreadable document" and len(errors) == 2
    some = zone.documents_at(listed.where("city_slug in ('city 1', 'city 2')"), str(root))
    assert sorted(r.city_slug for r in some.collect()) == ["city 1", "city 2"]


def test_an_absent_zone_is_empty(spark, tmp_path):
    assert zone.list_documents(spark, str(tmp_path / "none")).count() == 0


def test_written_documents_replace_earlier_ones(spark, tmp_path):
    schema = "daily struct<time: array<string>, temperature_2m_max: array<double>>, city_slug string, year int"
    for value in (1.0, 2.0):
        rows = [({"time": ["2000-01-01"], "temperature_2m_max": [value]}, f"c{n}", 2000) for n in range(5)]
        zone.write_documents(spark.createDataFrame(rows, schema), f"file:{tmp_path}/zone")
    files = sorted(p.relative_to(tmp_path / "zone").as_posix() for p in (tmp_path / "zone").rglob("*.json"))
    assert files == [f"c{n}/2000.json" for n in range(5)]
    read = zone.read_documents(spark, f"{tmp_path}/zone")
    assert {tuple(r.daily.temperature_2m_max) for r in read.collect()} == {(2.0,)}


def test_a_batch_holds_the_files_modified_between_two_moments(root):
    stream = zone.ZoneStream({"path": str(root), "shares": "3"})
    start, end = stream.initialOffset(), stream.latestOffset()
    read = lambda a, b: sorted(s for p in stream.partitions(a, b) for batch in stream.read(p) for s in batch.column("city_slug").to_pylist())
    assert len(read(start, end)) == 32 and read(end, end) == []
    put(root, "city 7", 2001, document(days_of(2001, 9)))
    moment = (end["until"] + 2_000_000) / 1e6
    os.utime(root / "city 7" / "2001.json", (moment, moment))
    assert read(end, {"until": end["until"] + 3_000_000}) == ["city 7"]
    assert read(end, {"until": end["until"] + 1_000_000}) == []
    late = zone.ZoneStream({"path": str(root), "settle_seconds": "60"})
    assert late.latestOffset()["until"] < end["until"] - 50_000_000


class FakeState:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_only_newer_days_pass():
    processor = keyed.NewestDays()
    processor.newest = FakeState()

    def deliver(*rows):
        frame = pd.DataFrame(rows, columns=["date", "moment", "content", "x"])
        halves = iter([frame.iloc[::2], frame.iloc[1::2]])
        found = list(processor.handleInputRows(("a", 2000), halves, None))
        return sorted(tuple(r) for f in found for r in f[["date", "moment", "x"]].itertuples(index=False))

    first, last = date(2000, 1, 1), date(2000, 12, 31)
    assert deliver((first, 5, 1, "a"), (last, 5, 1, "b"), (first, 4, 9, "c")) == [(first, 5, "a"), (last, 5, "b")]
    assert deliver((first, 5, 1, "a"), (last, 3, 1, "late")) == []
    assert deliver((first, 6, 2, "d"), (first, 6, 7, "e"), (last, 5, 3, "again")) == [(first, 6, "e")]


def test_deliveries_in_any_order_leave_the_newest_days(spark, tmp_path):
    schema = "city_id long, city_name string, country_code string, city_slug string, year long, date date, x double, modified_at timestamp"
    moment = lambda n: datetime(2020, 1, 1) + timedelta(minutes=n)
    row = lambda c, d, n: (c, f"city {c}", "XX", f"city_{c}", d.year, d, float(n), moment(n))
    days = days_of(2000, 12) + days_of(2001, 3)
    batches = [
        [row(c, d, 1) for c in (1, 2) for d in days],
        [row(1, d, 3) for d in days[:5]] + [row(2, d, 1) for d in days] + [row(1, d, 0) for d in days],
        [row(1, d, 2) for d in days] + [row(3, days[0], 1)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        keyed.append_newest_days(stream, f"{tmp_path}/log", f"{tmp_path}/checkpoint").awaitTermination()
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.count() == 30 + 5 + 10 + 1  # repeats and late rows never reach the log
    found = {(r.city_id, r.date): r.x for r in keyed.current_days(spark, f"{tmp_path}/log").collect()}
    expected = {(c, d): 1.0 for c in (1, 2) for d in days} | {(1, d): 2.0 for d in days} | {(1, d): 3.0 for d in days[:5]} | {(3, days[0]): 1.0}
    assert found == expected
