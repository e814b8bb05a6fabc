"""Candidate links by sign projections: recall, opposite and shifted series, copies, and no pairwise work."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from test_telecon import SCHEMA, assert_same, brute_lags, make

from isotherm.config import ClimateConfig
from isotherm.operators import similar, telecon
from isotherm.sources import scratch


def fleet(groups=12, members=6, months=120, noise=0.3, seed=1):
    """Groups of cities that follow one series, some late, some upside down; and loners."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [rng.gauss(0, 1) for _ in range(months + 10)]
        for m in range(members):
            late, sign = rng.randint(0, 3), rng.choice([1, 1, -1])
            for t in range(months):
                if rng.random() > 0.03:
                    x = sign * base[t + 5 - late] + rng.gauss(0, noise)
                    rows.append((g * members + m, f"c{g}.{m}", 1990 + t // 12, t % 12 + 1, x))
    for c in range(40):
        rows += [(1000 + c, f"alone {c}", 1990 + t // 12, t % 12 + 1, rng.gauss(0, 1)) for t in range(months)]
    return rows


def strong(rows, config, threshold=0.8):
    return {k: v for k, v in brute_lags(rows, config.max_lag).items() if v[1] is not None and abs(v[1]) >= threshold}


def test_strong_links_are_found_and_exact(spark):
    rows, config = fleet(), ClimateConfig(max_lag=4)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = similar.similar_links(frame, config).collect()
    expected = strong(rows, config)
    assert len(expected) > 300
    assert_same({(r.city_id, r.other_city_id, r.lag_months): (r.n_observations, r.anomaly_correlation) for r in found}, expected)
    pairs = similar.candidate_links(frame, config)
    n = 12 * 6 + 40
    assert pairs.where("city_id >= other_city_id").count() == 0
    assert pairs.count() < n * (n - 1) / 2  # not all pairs, even of so few cities


def test_recall_at_the_threshold_is_what_was_asked_for(spark):
    rows, config = fleet(groups=30, members=4, months=96, noise=0.55, seed=2), ClimateConfig(max_lag=3)
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = strong(rows, config, 0.7)
    pairs = {(r.city_id, r.other_city_id) for r in similar.candidate_links(frame, config, threshold=0.7, recall=0.95).collect()}
    wanted = {tuple(sorted(k[:2])) for k in expected}
    assert len(wanted) > 60
    assert len(wanted & pairs) >= 0.9 * len(wanted)


def test_strongest_similar_equals_strongest_links(spark):
    rows, config = fleet(groups=8, seed=3), ClimateConfig(max_lag=4)
    copies = [(5000 + k, "copy", y, m, x) for k in range(60) for c, _, y, m, x in rows if c == 1]
    frame = spark.createDataFrame(rows + copies, SCHEMA)
    exact = {r.city_id: r for r in telecon.strongest_links(frame, config).collect() if (r.max_lagged_corr or 0) >= 0.8}
    found = {r.city_id: r for r in similar.strongest_similar(frame, config).collect()}
    assert found.keys() == exact.keys() and len(found) > 100
    for city, r in exact.items():
        assert math.isclose(found[city].max_lagged_corr, r.max_lagged_corr, abs_tol=1e-9)
        assert found[city].lead_lag_months == r.lead_lag_months
    twins = {r.city_id: (r.first, r.last) for r in similar.twins(frame).collect()}
    assert twins[5003] == twins[1] == (1, 5059) and twins[2] == (2, 2)


def test_signs_are_repeatable_and_constant_series_have_none(spark):
    rows = make(8, 40) + [(50, "flat", 2000, m, 3.0) for m in range(1, 13)] + [(51, "empty", 2000, 1, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    first = similar.signatures(frame, 2, 6, 5).collect()
    assert sorted(first) == sorted(similar.signatures(frame.repartition(4), 2, 6, 5).collect())
    cities = {r.city_id for r in first}
    assert 50 not in cities and 51 not in cities and 5 not in cities and len(first) == len(cities) * 5 * 3
    assert all(r.bucket % 2 == 0 and 0 <= r.bucket < 64 for r in first)


@pytest.mark.parametrize("rows", [[], [(1, "a", 2000, 1, 1.0)]])
def test_no_partner(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    assert similar.similar_links(frame).count() == 0 and similar.strongest_similar(frame).count() == 0


def links_of(frame):
    keys = ("city_id", "city_name", "other_city_id", "other_city_name", "lag_months")
    return {tuple(r[k] for k in keys): (r.n_observations, r.anomaly_correlation) for r in frame.collect()}


@pytest.mark.parametrize("enough", [1 / 32, 2.0])
def test_links_of_many_tiles_are_those_of_all_pairs(spark, monkeypatch, enough):
    monkeypatch.setattr(similar, "TILE", 9)
    monkeypatch.setattr(similar, "LEAST_ALIKE", 3)
    monkeypatch.setattr(similar, "ENOUGH", enough)  # 2: what is marked is computed pair by pair
    rows = fleet(groups=9, seed=4)
    rows += [(2000 + c, "late", 1990 + t // 12, t % 12 + 1, math.sin((t - c % 4) ** 2)) for c in range(20) for t in range(c % 4, 60)]
    rows += [(3, "second name", y, m, 2 * x) for c, _, y, m, x in rows if c == 8] + [(3000, "flat", 1990, m, 1.1) for m in range(1, 13)]
    frame, config = spark.createDataFrame(rows, SCHEMA), ClimateConfig(max_lag=4, block_size=40)
    expected = links_of(telecon.lag_correlations(frame, config).where("abs(anomaly_correlation) >= 0.8"))
    found = similar.similar_links(frame, config).collect()
    assert len(found) == len(expected) > 500  # no link comes twice
    assert_same(links_of(similar.similar_links(frame, config)), expected)
    best = {r.city_id: (1, r.max_lagged_corr, r.lead_lag_months) for r in similar.strongest_similar(frame, config).collect()}
    wanted = telecon.best_lag(similar.similar_links(frame, config)).collect()
    assert {k: v[2] for k, v in best.items()} == {r.city_id: r.lead_lag_months for r in wanted}
    assert_same({k: v[:2] for k, v in best.items()}, {r.city_id: (1, r.max_lagged_corr) for r in wanted})


def test_no_bucket_and_no_pair_is_moved(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(scratch, "_written", lambda frame, path, write=scratch._written: stored.append(frame.columns) or write(frame, path))
    found = similar.similar_links(spark.createDataFrame(fleet(groups=4), SCHEMA), ClimateConfig(max_lag=2))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Join" not in plan  # series by city, then series by pair of blocks
    similar.strongest_similar(spark.createDataFrame(fleet(groups=4), SCHEMA), ClimateConfig(max_lag=2))
    assert not any("bucket" in columns or "other_city_id" in columns for columns in stored)


def test_tables_end_when_tiles_are_computed_as_a_whole(spark):
    directions = similar._directions(np.arange(-2, 50), 64 * 10)
    series = np.random.default_rng(1).standard_normal((1, 50)) + 0.1 * np.random.default_rng(2).standard_normal((40, 50))
    points = pa.array([[{"t": t, "x": x} for t, x in enumerate(one)] for one in series])
    table = pa.table({"city_id": np.arange(40), "city_name": ["a"] * 40, "series": points})
    block = telecon._Block(table, *telecon._time_axis(table, 2))
    codes = similar._Codes(block.tile(np.arange(40)), directions, 2, 10)
    met, whole = similar._met(codes, codes, 64, similar.ENOUGH)
    assert whole and list(codes.parts) == [0]
    met, whole = similar._met(codes, codes, 64, 2.0)
    assert not whole and met.all() and len(codes.parts) == 4


def test_plan():
    signs, tables = similar._plan(1_000_000, 6, 0.8, 0.99)
    assert signs == 21 and tables <= similar.MOST_TABLES
    assert similar._plan(10, 6, 0.8, 0.99)[0] == 5
