import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from isotherm.operators.positions import running_totals


def expected(rows):
    before, total = {}, 0
    for key, n in sorted(rows):
        before[key] = total
        total += n
    return before


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.sets(st.integers(-10**12, 10**12), min_size=1, max_size=40),
    buckets=st.sampled_from([2, 7, 256]),
)
def test_running_totals_over_integers(spark, keys, buckets):
    rng = random.Random(len(keys))
    rows = [(k, rng.randint(0, 9)) for k in keys]
    frame = spark.createDataFrame(rows, "k long, n long")
    found = {r.k: r.n_before for r in running_totals(frame, "k", ["n"], buckets).collect()}
    assert found == expected(rows)


def test_one_narrow_range_holds_nearly_all_rows(spark):
    rng = random.Random(1)
    rows = [(rng.random() * 1e-6, 1) for _ in range(3000)] + [(float(i), 2) for i in range(1, 20)]
    frame = spark.createDataFrame(rows, "k double, n long").repartition(6)
    found = {r.k: r.n_before for r in running_totals(frame, "k", ["n"], 16).collect()}
    assert found == expected(rows)


def test_rows_spread_evenly_over_the_buckets(spark):
    """The window partitions stay small although the values are skewed."""
    frame = spark.range(20000).selectExpr("double(pow(id, 4)) as k", "1L as n")
    plan = running_totals(frame, "k", ["n"], 32)
    assert plan.count() == 20000
    assert plan.agg({"n_before": "max"}).first()[0] == 19999


def test_empty(spark):
    frame = spark.createDataFrame([], "k long, n long")
    assert running_totals(frame, "k", ["n"]).count() == 0


@pytest.mark.parametrize("names", [["a", "b"]])
def test_several_totals(spark, names):
    frame = spark.createDataFrame([(3, 1, 10), (1, 2, 20), (2, 3, 30)], "k long, a long, b long")
    rows = {r.k: (r.a_before, r.b_before) for r in running_totals(frame, "k", names).collect()}
    assert rows == {1: (0, 0), 2: (2, 20), 3: (5, 50)}
