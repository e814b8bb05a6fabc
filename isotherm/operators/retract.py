"""Monthly climate and climatology as states that a correction can be taken out of.

A state row holds count, mean and the sum of squared deviations (M2) of each measure. Two groups merge
into one, and a group can be taken out of a larger one again, by the pairwise update of these
three. So a corrected day changes its own city and month, and that month its own cell of the
climatology; nothing else is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.operators.clean import MONTHLY_KEYS

# Measure of the clean daily table -> monthly column; means first, then totals.
MEANS = {
    "tmax_c": "avg_tmax_c",
    "tmin_c": "avg_tmin_c",
    "tmean_c": "avg_tmean_c",
    "dewpoint_c": "avg_dewpoint_c",
    "wind_max_ms": "avg_wind_max_ms",
    "sw_radiation": "avg_sw_radiation",
}
TOTALS = {"precip_mm": "total_precip_mm"}
COUNTS = {
    "is_heat_day": "heat_day_count",
    "is_tropical_night": "tropical_night_count",
    "is_heavy_precip_day": "heavy_precip_day_count",
    "is_summer": "summer_day_count",
}

BASELINE_KEYS = ("city_id", "city_name", "country_code", "month")
BASELINE = ("avg_tmean_c", "avg_tmax_c", "avg_tmin_c", "total_precip_mm")


def signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of both sides with `sign` -1 (to be taken out) and 1 (to be put in)."""
    return before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))


def _group(measure: str, side: Column) -> list[Column]:
    """Count, mean and M2 of a measure over the rows of one side."""
    x = F.when(side, F.col(measure))
    n = F.count(x)
    spread = F.coalesce(F.var_pop(x) * n, F.lit(0.0))
    return [n.alias("n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"), spread.alias("m2")]


def changes(
    rows: DataFrame, keys: Sequence[str], measures: Sequence[str], counts: Sequence[str] = ()
) -> DataFrame:
    """Per key, the groups to be taken out and put in: `out_` and `in_` each measure; `n_rows` and counts are differences.

    One algebraic aggregate: days shrink to their keys before the shuffle.
    """
    put, taken = F.col("sign") > 0, F.col("sign") < 0
    return rows.groupBy(*keys).agg(
        F.sum("sign").cast("long").alias("n_rows"),
        *[F.struct(*_group(m, taken)).alias(f"out_{m}") for m in measures],
        *[F.struct(*_group(m, put)).alias(f"in_{m}") for m in measures],
        *[F.coalesce(F.sum(F.col(c) * F.col("sign")), F.lit(0)).cast("long").alias(c) for c in counts],
    )


def _state(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def _nothing() -> Column:
    return _state(F.lit(0).cast("long"), F.lit(0.0), F.lit(0.0))


def exchanged(a: Column, out: Column, new: Column) -> Column:
    """Group `a` without its part `out` and with the group `new`.

    Sums are taken about the mean of `a`, so neither step loses digits to the level of the values.
    """
    centre = F.when(a["n"] > 0, a["mean"]).otherwise(new["mean"])
    gone, come = out["mean"] - centre, new["mean"] - centre
    n = a["n"] - out["n"] + new["n"]
    moved = new["n"] * come - out["n"] * gone
    squares = a["m2"] - out["m2"] - out["n"] * gone * gone + new["m2"] + new["n"] * come * come
    # one value has no spread, whatever rounding has left of it
    spread = F.when(n > 1, F.greatest(squares - moved * moved / n, F.lit(0.0))).otherwise(0.0)
    return F.when(n > 0, _state(n, centre + moved / n, spread)).otherwise(_nothing())


def merged(a: Column, b: Column) -> Column:
    """The group of both."""
    return exchanged(a, _nothing(), b)


def unmerged(a: Column, b: Column) -> Column:
    """What is left of group `a` without its part `b`."""
    return exchanged(a, b, _nothing())


def applied(
    state: DataFrame, change: DataFrame, keys: Sequence[str], measures: Sequence[str], counts: Sequence[str] = ()
) -> DataFrame:
    """The state rows of the changed keys after the change; keys without rows left are not among them.

    `state` may hold any keys; only those of `change` come back. Nulls in keys are values of their own.
    """
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"state.{key}").eqNullSafe(F.col(f"change.{key}"))
    met = change.alias("change").join(state.alias("state"), same, "left")
    columns = [F.col(f"change.{k}").alias(k) for k in keys]
    for c in ("n_rows", *counts):
        columns.append((F.coalesce(f"state.{c}", F.lit(0).cast("long")) + F.col(f"change.{c}")).alias(c))
    for m in measures:
        held = F.coalesce(F.col(f"state.{m}"), _nothing())
        columns.append(exchanged(held, F.col(f"change.out_{m}"), F.col(f"change.in_{m}")).alias(m))
    return met.select(*columns).where("n_rows > 0")


# ---------------------------------------------------------------------------- months

MONTH_MEASURES = (*MEANS, *TOTALS)


def month_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Clean days that go and come, as changes of their months."""
    return changes(signed(before, after), MONTHLY_KEYS, MONTH_MEASURES, tuple(COUNTS))


def month_states(daily: DataFrame) -> DataFrame:
    """The states of all months of a clean daily table."""
    return _as_states(month_changes(daily.limit(0), daily), MONTHLY_KEYS, MONTH_MEASURES, tuple(COUNTS))


def apply_months(states: DataFrame, change: DataFrame) -> DataFrame:
    """The states of the months that `month_changes` touches."""
    return applied(states, change, MONTHLY_KEYS, MONTH_MEASURES, tuple(COUNTS))


def _as_states(change: DataFrame, keys: Sequence[str], measures: Sequence[str], counts: Sequence[str] = ()) -> DataFrame:
    """Changes of nothing are states."""
    return change.select(*keys, "n_rows", *[F.col(f"in_{m}").alias(m) for m in measures], *counts).where("n_rows > 0")


def months_of(states: DataFrame) -> DataFrame:
    """`clean.monthly_climate` from its states."""

    def known(m: str, value: Column) -> Column:
        return F.when(F.col(m)["n"] > 0, value)

    return states.select(
        *MONTHLY_KEYS,
        F.col("n_rows").alias("days_in_month"),
        *[known(m, F.col(m)["mean"]).alias(name) for m, name in MEANS.items()],
        *[known(m, F.col(m)["mean"] * F.col(m)["n"]).alias(name) for m, name in TOTALS.items()],
        *[F.col(c).alias(name) for c, name in COUNTS.items()],
    )


# ---------------------------------------------------------------------------- climatology


def baseline_changes(before: DataFrame, after: DataFrame, config: ClimateConfig = ClimateConfig()) -> DataFrame:
    """Months that go and come, as changes of their cells of the climatology."""
    rows = signed(before, after).where(F.col("year").between(config.baseline_first_year, config.baseline_last_year))
    return changes(rows, BASELINE_KEYS, BASELINE)


def baseline_states(monthly: DataFrame, config: ClimateConfig = ClimateConfig()) -> DataFrame:
    return _as_states(baseline_changes(monthly.limit(0), monthly, config), BASELINE_KEYS, BASELINE)


def apply_baseline(states: DataFrame, change: DataFrame) -> DataFrame:
    """The cells of the climatology that `baseline_changes` touches."""
    return applied(states, change, BASELINE_KEYS, BASELINE)


def climatology_of(states: DataFrame) -> DataFrame:
    """`anomaly.climatology` from its states."""

    def mean(m: str) -> Column:
        return F.when(F.col(m)["n"] > 0, F.col(m)["mean"])

    def spread(m: str) -> Column:
        return F.when(F.col(m)["n"] > 1, F.sqrt(F.col(m)["m2"] / (F.col(m)["n"] - 1)))

    names = {m: m.removeprefix("avg_") for m in BASELINE}
    return states.select(
        *BASELINE_KEYS,
        *[mean(m).alias(f"climatology_{names[m]}") for m in BASELINE],
        spread("avg_tmean_c").alias("climatology_tmean_std_c"),
        spread("total_precip_mm").alias("climatology_total_precip_std_mm"),
    )


def kept(table: DataFrame, change: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a stored table whose key the change does not touch."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"table.{key}").eqNullSafe(F.col(f"change.{key}"))
    return table.alias("table").join(change.select(*keys).alias("change"), same, "left_anti")
