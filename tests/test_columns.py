from datetime import date

import pytest
from pyspark.sql import functions as F

from isotherm.functions import columns as c

AS_OF = date(2024, 3, 10)


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_slugify(spark):
    rows = [("  São Paulo ",), ("NEW YORK CITY",), (None,)]
    assert values(spark, rows, "n string", c.slugify(F.col("n"))) == ["são_paulo", "new_york_city", None]


@pytest.mark.parametrize(
    "path, slug",
    [
        ("file:/raw/oslo/1980.json", "oslo"),
        ("file:/raw/s%C3%A3o%20paulo/1980.json", "são paulo"),
        ("file:/raw/a+b/1980.json", "a+b"),
        ("lone.json", None),
    ],
)
def test_path_segment(spark, path, slug):
    assert values(spark, [(path,)], "p string", c.path_segment(F.col("p"), 2)) == [slug]


def test_month_labels(spark):
    months = [(m,) for m in (1, 3, 8, 11, 12, 13, None)]
    assert values(spark, months, "m int", c.month_name(F.col("m"))) == [
        "January", "March", "August", "November", "December", None, None,
    ]
    assert values(spark, months, "m int", c.season(F.col("m"))) == [
        "DJF", "MAM", "JJA", "SON", "DJF", None, None,
    ]


def test_unknown_conditions_do_not_count(spark):
    rows = [(30.0,), (29.9,), (None,)]
    assert values(spark, rows, "t double", c.flag(F.col("t") >= 30)) == [1, 0, 0]
    assert values(spark, rows, "t double", c.truth(F.col("t") >= 30)) == [True, False, False]


def test_standardize_guards_the_spread(spark):
    rows = [(2.0, 0.5), (2.0, 0.0), (2.0, None), (2.0, -1.0)]
    assert values(spark, rows, "d double, s double", c.standardize(F.col("d"), F.col("s"))) == [
        4.0, None, None, None,
    ]


def test_ratio(spark):
    assert values(spark, [(1, 4), (1, 0)], "a int, b int", c.ratio(F.col("a"), F.col("b"))) == [0.25, None]


@pytest.mark.parametrize(
    "last, kind",
    [
        (date(2024, 3, 10), "fresh"),
        (date(2024, 3, 9), "fresh"),
        (date(2024, 3, 8), "stale"),
        (date(2024, 3, 3), "stale"),
        (date(2024, 3, 2), "very_stale"),
        (None, "unknown"),
    ],
)
def test_freshness(spark, last, kind):
    assert values(spark, [(last,)], "d date", c.freshness(F.col("d"), AS_OF)) == [kind]


def test_month_index_is_calendar_distance(spark):
    rows = [(1999, 12), (2000, 1)]
    december, january = values(spark, rows, "y int, m int", c.month_index(F.col("y"), F.col("m")))
    assert january - december == 1
