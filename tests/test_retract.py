"""States of months and climatology: groups exchanged, and chains of corrections equal to full computation."""

import math
import random
import statistics
from datetime import date, timedelta

from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.operators import anomaly, clean, retract

CONFIG = ClimateConfig(baseline_first_year=2000, baseline_last_year=2003)
LANDED = "city_id long, city_name string, country_code string, date date, " + ", ".join(f"{v} double" for v in CONFIG.variables)


def group(values):
    n = len(values)
    mean = statistics.fmean(values) if n else 0.0
    return n, mean, float(sum((v - mean) ** 2 for v in values))


def test_groups_are_exchanged(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        stay, out, new = ([rng.gauss(1e4, 1) for _ in range(rng.choice([0, 0, 1, 2, 7]))] for _ in range(3))
        rows.append((group(stay + out), group(out), group(new), group(stay + new)))
    kind = "struct<n: long, mean: double, m2: double>"
    frame = spark.createDataFrame(rows, f"a {kind}, o {kind}, i {kind}, e {kind}")
    found = frame.select(retract.exchanged(F.col("a"), F.col("o"), F.col("i")).alias("x"), "e").collect()
    for r in found:
        assert r.x.n == r.e.n and (not r.e.n or math.isclose(r.x.mean, r.e.mean, rel_tol=1e-12))
        assert math.isclose(r.x.m2, r.e.m2, abs_tol=1e-6)
    both = frame.select(retract.merged(F.col("o"), F.col("i")).alias("m"), retract.unmerged(F.col("a"), F.col("o")).alias("u"), "a", "o", "i").collect()
    assert all(r.m.n == r.o.n + r.i.n and r.u.n == r.a.n - r.o.n and r.u.m2 >= 0 for r in both)


def days(seed, cities=4, first=date(1999, 11, 1), count=1900):
    rng = random.Random(seed)
    rows = []
    for c in range(cities):
        for d in range(count):
            if rng.random() > 0.2:
                values = [None if rng.random() < 0.05 else rng.gauss(15, 12) for _ in CONFIG.variables]
                rows.append((c, f"city {c}", "XX" if c else None, first + timedelta(d), *values))
    return rows


def same(found, expected, keys):
    found, expected = ({tuple(r[k] for k in keys): r.asDict() for r in f.collect()} for f in (found, expected))
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        for name, value in row.items():
            other = found[key][name]
            assert (other is None) == (value is None), (key, name)
            assert value is None or other == value or math.isclose(other, value, abs_tol=1e-8), (key, name)


def test_a_chain_of_corrections_equals_full_computation(spark):
    rng = random.Random(7)
    rows = days(1)
    daily = lambda r: clean.clean_daily(spark.createDataFrame(r, LANDED), CONFIG)
    months = retract.month_states(daily(rows))
    cells = retract.baseline_states(retract.months_of(months), CONFIG)
    for step in range(2):
        gone = [r for r in rows if r[3].month == 2 and r[0] == step or rng.random() < 0.02]
        kept = [r for r in rows if r not in set(gone)]
        come = [(*r[:4], *[rng.gauss(10, 3) for _ in CONFIG.variables]) for r in gone if rng.random() < 0.7 and r[3].year != 2001]
        rows = kept + come
        change = retract.month_changes(daily(gone), daily(come))
        new = retract.apply_months(months, change)
        keys = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in clean.MONTHLY_KEYS]
        old = months.alias("s").join(change.alias("c"), keys, "left_semi")
        of_cells = retract.baseline_changes(retract.months_of(old), retract.months_of(new), CONFIG)
        cells = retract.kept(cells, of_cells, retract.BASELINE_KEYS).unionByName(retract.apply_baseline(cells, of_cells))
        months = retract.kept(months, change, clean.MONTHLY_KEYS).unionByName(new)
    full = clean.monthly_climate(daily(rows))
    same(retract.months_of(months), full, ("city_id", "year", "month"))
    same(retract.climatology_of(cells), anomaly.climatology(full, CONFIG), ("city_id", "month"))


def test_nothing(spark):
    none = clean.clean_daily(spark.createDataFrame([], LANDED), CONFIG)
    assert retract.months_of(retract.month_states(none)).count() == 0
    assert retract.climatology_of(retract.baseline_states(retract.months_of(retract.month_states(none)), CONFIG)).count() == 0
