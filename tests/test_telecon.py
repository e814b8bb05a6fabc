import math
import random

import numpy as np
import pytest

from isotherm.config import ClimateConfig
from isotherm.operators import telecon

SCHEMA = "city_id long, city_name string, year long, month long, anomaly_tmean_c double"


def make(cities=23, months=40, seed=7):
    """Noisy series with gaps, missing values, a constant city and a copy of another city."""
    rng = random.Random(seed)
    rows = []
    for c in range(cities):
        for t in range(months):
            if rng.random() < 0.15:
                continue
            x = rng.gauss(0, 1)
            if c == 5:
                x = 2.5
            if c == 6:
                x = math.sin(t)
            if c == 7:
                x = math.sin(t + 2)
            rows.append((c, f"city {c}", 2000 + t // 12, t % 12 + 1, None if rng.random() < 0.05 else x))
    return rows


def brute_lags(rows, max_lag):
    series = {}
    for c, _, y, m, x in rows:
        series.setdefault(c, {})[y * 12 + m] = x
    result = {}
    for a, own in series.items():
        for b, other in series.items():
            if a == b:
                continue
            for lag in range(-max_lag, max_lag + 1):
                pairs = [(x, other[t + lag]) for t, x in own.items() if t + lag in other]
                if not pairs:
                    continue
                known = [(x, y) for x, y in pairs if x is not None and y is not None]
                r = None
                if len(known) > 1:
                    x, y = np.array(known).T
                    if np.ptp(x) > 0 and np.ptp(y) > 0:
                        r = float(np.corrcoef(x, y)[0, 1])
                result[a, b, lag] = (len(pairs), r)
    return result


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, (n, r) in expected.items():
        assert found[key][0] == n, key
        assert (found[key][1] is None) == (r is None), key
        assert r is None or abs(found[key][1] - r) < 1e-9, key


@pytest.mark.parametrize("block_size", [4, 256])
def test_lags_equal_brute_force(spark, block_size):
    rows = make()
    config = ClimateConfig(max_lag=3, block_size=block_size)
    lags = telecon.lag_correlations(spark.createDataFrame(rows, SCHEMA).repartition(5), config)
    collected = lags.collect()
    found = {
        (r.city_id, r.other_city_id, r.lag_months): (r.n_observations, r.anomaly_correlation)
        for r in collected
    }
    assert len(found) == len(collected)
    expected = brute_lags(rows, 3)
    assert_same(found, expected)
    assert all(r.city_name == f"city {r.city_id}" for r in collected)
    # the mirror image of a pair has the negated lag
    for (a, b, lag), value in found.items():
        n, r = found[b, a, -lag]
        assert n == value[0] and (r == value[1] or abs(r - value[1]) < 1e-12)
    assert all(r is None or -1 <= r <= 1 for _, r in found.values())


@pytest.mark.parametrize("block_size", [4, 256])
def test_pairs_equal_lag_zero(spark, block_size):
    rows = make()
    config = ClimateConfig(block_size=block_size)
    pairs = telecon.pair_correlations(spark.createDataFrame(rows, SCHEMA), config).collect()
    found = {
        (r.city_id_1, r.city_id_2, 0): (r.n_observations, r.anomaly_correlation) for r in pairs
    }
    assert len(found) == len(pairs)
    assert_same(found, {k: v for k, v in brute_lags(rows, 0).items() if k[0] < k[1]})


@pytest.mark.parametrize("block_size", [3, 256])
def test_strongest_links_equal_best_lag(spark, block_size):
    frame = spark.createDataFrame(make(), SCHEMA)
    config = ClimateConfig(max_lag=3, block_size=block_size)
    table = {r.city_id: r for r in telecon.best_lag(telecon.lag_correlations(frame, config)).collect()}
    direct = {r.city_id: r for r in telecon.strongest_links(frame, config).collect()}
    assert table.keys() == direct.keys()
    for city, row in table.items():
        if row.max_lagged_corr is None:
            assert city == 5 and direct[city].max_lagged_corr is None
            assert row.lead_lag_months is None and direct[city].lead_lag_months is None
        else:
            assert abs(direct[city].max_lagged_corr - row.max_lagged_corr) < 1e-12
            assert direct[city].lead_lag_months == row.lead_lag_months


def test_ties_go_to_the_nearest_then_negative_lag(spark):
    rows = [(1, 3, 0.5), (1, -2, -0.5), (1, 2, 0.5), (1, 0, 0.1), (2, 1, None), (2, 0, None)]
    lags = spark.createDataFrame(rows, "city_id long, lag_months long, anomaly_correlation double")
    best = {r.city_id: tuple(r)[1:] for r in telecon.best_lag(lags).collect()}
    assert best == {1: (0.5, -2), 2: (None, None)}


def test_renamed_city_is_two_series(spark):
    rows = [(1, "old", 2000, m, float(m)) for m in (1, 2, 3)]
    rows += [(1, "new", 2000, m, float(m)) for m in (4, 5, 6)]
    rows += [(2, "b", 2000, m, float(m * m)) for m in range(1, 7)]
    pairs = telecon.pair_correlations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.city_name_1, r.city_name_2, r.n_observations) for r in pairs} == {
        ("old", "b", 3), ("new", "b", 3),
    }


def test_repeated_month_counts_every_combination(spark):
    rows = [(1, "a", 2000, m, float(x)) for m, x in ((1, 1), (1, 2), (2, 5), (3, 4))]
    rows += [(2, "b", 2000, m, float(x)) for m, x in ((1, 3), (2, 1), (3, 7), (3, 9))]
    pair = telecon.pair_correlations(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    combined = [(1, 3), (2, 3), (5, 1), (4, 7), (4, 9)]
    assert pair.n_observations == 5
    assert abs(pair.anomaly_correlation - np.corrcoef(np.array(combined).T)[0, 1]) < 1e-12


@pytest.mark.parametrize("max_lag", [0, 2, 6])
def test_stray_dates_and_long_gaps(spark, max_lag):
    rng = random.Random(5)
    rows = []
    for c in range(6):
        for y in (1, 1900, 1901, 1950, 2000, 2001, 9999):
            for m in rng.sample(range(1, 13), 7):
                rows.append((c, f"city {c}", y, m, rng.gauss(0, 1)))
    config = ClimateConfig(max_lag=max_lag, block_size=2)
    lags = telecon.lag_correlations(spark.createDataFrame(rows, SCHEMA), config).collect()
    found = {
        (r.city_id, r.other_city_id, r.lag_months): (r.n_observations, r.anomaly_correlation)
        for r in lags
    }
    assert_same(found, brute_lags(rows, max_lag))


def test_no_partner_and_empty_input(spark):
    alone = spark.createDataFrame([(1, "a", 2000, 1, 1.0), (None, "x", 2000, 1, 1.0)], SCHEMA)
    assert telecon.lag_correlations(alone).count() == 0
    assert telecon.strongest_links(alone).count() == 0
    assert telecon.pair_correlations(alone.limit(0)).count() == 0


def test_chosen_number_of_pair_tasks(spark):
    frame = spark.createDataFrame(make(9, 12), SCHEMA)
    config = ClimateConfig(block_size=2, pair_partitions=5)
    spread = telecon.pair_correlations(frame, config)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block_lo") == 1
    assert sorted(map(tuple, spread.select("city_id_1", "city_id_2").collect())) == sorted(
        map(tuple, telecon.pair_correlations(frame).select("city_id_1", "city_id_2").collect())
    )


def test_plan_has_no_nested_loop(spark):
    frame = spark.createDataFrame(make(5, 12), SCHEMA)
    for operator in (telecon.pair_correlations, telecon.lag_correlations, telecon.strongest_links):
        plan = operator(frame)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_candidate_pairs_and_as_of(spark):
    rows = make()
    frame = spark.createDataFrame(rows, SCHEMA)
    config = ClimateConfig(block_size=4)
    pairs = spark.createDataFrame([(1, 2), (9, 3), (3, 9), (5, 6), (4, 4)], "city_id long, other_city_id long")
    wanted = {(1, 2), (2, 1), (3, 9), (9, 3), (5, 6), (6, 5)}
    expected = {k: v for k, v in brute_lags(rows, config.max_lag).items() if k[:2] in wanted}
    found = telecon.lag_correlations(frame, config, pairs).collect()
    assert_same(
        {(r.city_id, r.other_city_id, r.lag_months): (r.n_observations, r.anomaly_correlation) for r in found}, expected
    )
    same_month = {(a, b): v for (a, b, lag), v in expected.items() if lag == 0 and a < b}
    found = telecon.pair_correlations(frame, config, pairs).collect()
    assert_same({(r.city_id_1, r.city_id_2): (r.n_observations, r.anomaly_correlation) for r in found}, same_month)
    early = frame.where("year * 12 + month <= 2001 * 12 + 6")
    cut = telecon.strongest_links(frame, config, as_of=(2001, 6)).collect()
    assert sorted(cut) == sorted(telecon.strongest_links(early, config).collect())
    few = telecon.strongest_links(frame, config, pairs)
    assert {r.city_id for r in few.collect()} == {1, 2, 3, 5, 6, 9}


def whole(cities=60, months=30, seed=3):
    """Series without gaps but for every fourth city, which lacks a month or a value; a constant one and a copy."""
    rng = random.Random(seed)
    rows = []
    for c in range(cities):
        for t in range(months):
            x = 2.5 if c == 5 else math.sin(t) if c in (6, 7) else rng.gauss(0, 1)
            if c % 4 == 0 and t == 3 + c % 20:
                if c % 8 == 0:
                    continue
                x = None
            rows.append((c, f"city {c}", 2000 + t // 12, t % 12 + 1, x))
    return rows


@pytest.mark.parametrize("tile", [7, 512])
def test_tiles_of_whole_and_gappy_series(spark, monkeypatch, tile):
    monkeypatch.setattr(telecon, "TILE", tile)
    rows = whole()
    frame = spark.createDataFrame(rows, SCHEMA)
    config = ClimateConfig(max_lag=3, block_size=25)
    lags = telecon.lag_correlations(frame, config).collect()
    found = {(r.city_id, r.other_city_id, r.lag_months): (r.n_observations, r.anomaly_correlation) for r in lags}
    assert len(found) == len(lags)
    assert_same(found, brute_lags(rows, 3))
    table = {r.city_id: r for r in telecon.best_lag(telecon.lag_correlations(frame, config)).collect()}
    for row in telecon.strongest_links(frame, config).collect():
        strength, lag = table[row.city_id][1:]
        assert (row.max_lagged_corr is None) == (strength is None) and row.lead_lag_months == lag
        assert strength is None or abs(row.max_lagged_corr - strength) < 1e-12


def test_a_large_fleet_has_larger_blocks_not_more(spark):
    assert [telecon.blocks_for(n, 32) for n in (0, 1, 32, 33, 1024, 60_000)] == [1, 1, 1, 2, 32, 32]
    assert telecon.blocks_for(10**6, 32) == 62
    rows = [(c, "c", 2000, m, float((c * 7 + m * m) % 11)) for c in range(600) for m in range(1, 4)]
    pairs = telecon.pair_correlations(spark.createDataFrame(rows, SCHEMA), ClimateConfig(block_size=2))
    assert pairs.count() == 600 * 599 // 2
    sent = telecon._block_pairs(spark.createDataFrame(rows, SCHEMA), telecon.blocks_for(600, 2))
    assert sent.count() == 600 * telecon.MOST_BLOCKS


def mixed(cities=90, months=30, seed=9):
    """Months shared by many cities, in two kinds; some cities with gaps, missing or repeated values, constant ones and copies."""
    rng = random.Random(seed)
    rows = []
    for c in range(cities):
        for t in range(months - (c % 3 == 0)):
            x = 2.5 if c in (5, 40) else math.sin(t * t) if c in (6, 7, 50) else rng.gauss(0, 1)
            if c % 9 == 4 and t == c % 20:
                continue
            rows.append((c, f"city {c}", 2000 + t // 12, t % 12 + 1, None if c % 10 == 8 and t == 11 else x))
    return rows + [(c, f"city {c}", 2001, 3, 0.75) for c in (8, 13)]


@pytest.mark.parametrize("shares", [(1 / 32, 1e-2), (0.0, 0.0), (1.0, 1.0)])
def test_strongest_links_of_tiles_with_few_kinds_of_months(spark, monkeypatch, shares):
    monkeypatch.setattr(telecon, "TILE", 11)
    monkeypatch.setattr(telecon, "MOST_NEAR", shares[0])
    monkeypatch.setattr(telecon, "MOST_ERROR", shares[1])
    rows = mixed() + [(200, "alone", 2090, 1, 1.0)]
    for frame in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA).where("year * 12 + month <= 24000 + 2")):
        for block_size in (30, 256):
            config = ClimateConfig(max_lag=3, block_size=block_size)
            table = {r.city_id: r for r in telecon.best_lag(telecon.lag_correlations(frame, config)).collect()}
            direct = {r.city_id: r for r in telecon.strongest_links(frame, config).collect()}
            assert table.keys() == direct.keys() and 200 not in direct
            for city, row in table.items():
                assert direct[city].lead_lag_months == row.lead_lag_months, city
                assert (direct[city].max_lagged_corr is None) == (row.max_lagged_corr is None)
                assert row.max_lagged_corr is None or abs(direct[city].max_lagged_corr - row.max_lagged_corr) < 1e-12


def test_few_kinds_of_months_give_few_tiles_without_gaps():
    rng = np.random.default_rng(4)
    months = np.arange(40)
    kinds = [months, months[:-1], months[months != 7], months]
    series = [[{"t": int(t), "x": float(rng.normal())} for t in kinds[(c % 40 == 0) + (c % 2) * (c % 40 != 0)]] for c in range(2_000)]
    columns = {"city_id": list(range(2_000)), "city_name": ["c"] * 2_000}
    kind = telecon.pa.list_(telecon.pa.struct([("t", telecon.pa.int64()), ("x", telecon.pa.float64())]))
    table = telecon.pa.table({**columns, "series": telecon.pa.array(series, kind)})
    tiles = telecon._Block(table, *telecon._time_axis(table, 3)).tiles(512)
    assert all(tile.whole for tile in tiles) and len(tiles) <= 5


def test_few_pairs_are_computed_in_full(monkeypatch):
    """The strongest links of tiles come from one product in single precision and from pairs that it cannot rule out."""
    rng = np.random.default_rng(6)
    points = [[{"t": t, "x": float(rng.normal())} for t in range(60 - c % 2)] for c in range(1_200)]
    kind = telecon.pa.list_(telecon.pa.struct([("t", telecon.pa.int64()), ("x", telecon.pa.float64())]))
    columns = {"city_id": list(range(1_200)), "city_name": ["c"] * 1_200}
    table = telecon.pa.table({**columns, "series": telecon.pa.array(points, kind)})
    block = telecon._Block(table, *telecon._time_axis(table, 6))
    full, some = [], []
    of = telecon._moments_of
    monkeypatch.setattr(telecon, "_moments", lambda *a: full.append(a))
    monkeypatch.setattr(telecon, "_moments_of", lambda a, i, *rest: some.append(len(i)) or of(a, i, *rest))
    best = [b for b, _ in telecon.strongest_of(block, None, 6)]
    assert not full and 0 < sum(some) < 1_200**2 / 20
    assert all((b.strength > 0.2).all() for b in best)


def series_table(series):
    """Packed and unpacked again, with the size of each packed city."""
    kind = telecon.pa.list_(telecon.pa.struct([("t", telecon.pa.int64()), ("x", telecon.pa.float64())]))
    values = [telecon.pa.array(v, k) for v, k in ((list(range(len(series))), telecon.pa.int64()), (["c"] * len(series), telecon.pa.string()))]
    batch = telecon.pa.RecordBatch.from_arrays([*values, telecon.pa.array(series, kind)], ["city_id", "city_name", "series"])
    sent = telecon.pa.Table.from_batches(telecon.packed(iter([batch])))
    return telecon.unpacked(sent)["series"].to_pylist(), [len(p) for p in sent["points"].to_pylist()]


def test_series_come_back_and_a_month_without_gaps_takes_one_value():
    rng = random.Random(1)
    whole = [{"t": 24_000 + t, "x": rng.gauss(0, 1)} for t in range(84)]
    gaps = [p for p in whole if p["t"] % 5]
    repeated = [*whole[:3], whole[1], {"t": 12, "x": None}, {"t": 119_999, "x": -0.0}, {"t": -3, "x": 2.5}]
    series = [rng.sample(whole, 84), gaps, repeated, [whole[7]], [{"t": t, "x": 2.5} for t in (1, 2, 4)]]
    found, sizes = series_table(series)
    assert sizes[0] <= 8 * 84 + 40 and sizes[4] <= 8 * 7
    for back, sent in zip(found, series):
        wanted = sorted(sent, key=lambda p: p["t"])
        assert [p["t"] for p in back] == [p["t"] for p in wanted]
        assert all(repr(a["x"]) == repr(b["x"]) or (b["x"] is None and math.isnan(a["x"])) for a, b in zip(back, wanted))
