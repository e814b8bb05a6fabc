"""Which (city, year) windows to load, and how a load attempt went."""

from __future__ import annotations

from datetime import date, timedelta
from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.functions.columns import slugify


def plan_windows(
    cities: DataFrame,
    mode: Literal["backfill", "recent", "coverage"] = "recent",
    landed: DataFrame | None = None,
    start: date | None = None,
    end: date | None = None,
    as_of: date | None = None,
    config: ClimateConfig = ClimateConfig(),
) -> DataFrame:
    """Work plan, one row per city and year with `window_start` and `window_end`.

    `backfill`: every year of [start, end], clamped to it, that has no document in `landed`
    (city_slug, year). `recent`: the current year up to the day before `as_of`; nothing on
    1 January. `coverage`: as backfill, but by days present: `landed` has (city_slug, date), and
    a window is planned while any of its days is missing, which also repairs a 31 December that
    the recent mode never reaches.
    """
    if mode == "recent":
        if as_of is None:
            raise ValueError("recent mode needs as_of")
        end = as_of - timedelta(days=1)
        start = date(as_of.year, 1, 1)
        if end < start:
            return _windows(cities, start, start).limit(0)
        return _windows(cities, start, end)

    start, end = start or config.start_date, end or config.end_date
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    plan = _windows(cities, start, end)
    if landed is None:
        return plan
    if mode == "backfill":
        present = landed.select("city_slug", "year")
        return plan.join(present, ["city_slug", "year"], "left_anti").select(*plan.columns)
    if mode != "coverage":
        raise ValueError(f"unknown mode: {mode}")
    # count distinct days per window; repeated rows of a day collapse before the shuffle
    days = (
        landed.where(F.col("date").between(start, end))
        .select("city_slug", F.year("date").cast("long").alias("year"), "date")
        .distinct()
        .groupBy("city_slug", "year")
        .agg(F.count(F.lit(1)).alias("n_landed"))
    )
    wanted = F.datediff("window_end", "window_start") + 1
    return (
        plan.join(days, ["city_slug", "year"], "left")
        .where(F.coalesce("n_landed", F.lit(0)) < wanted)
        .select(*plan.columns)
    )


def missing_windows(
    cities: DataFrame,
    landed: DataFrame,
    start: date | None = None,
    end: date | None = None,
    merge_days: int = 0,
    config: ClimateConfig = ClimateConfig(),
) -> DataFrame:
    """The fewest windows per city and year that hold all missing days, and how many each holds.

    `landed` has (city_slug, date). Runs of missing days become one window unless more than
    `merge_days` landed days lie between them, so with 0 no landed day is asked for again.
    Repeated days collapse before the shuffle, and a group is one year of one city.
    """
    start, end = start or config.start_date, end or config.end_date
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    plan = _windows(cities, start, end)
    days = landed.where(F.col("date").between(start, end)).select(
        "city_slug", F.year("date").cast("long").alias("year"), "date"
    )
    # a mark behind each window closes its last gap
    ends = plan.select("city_slug", "year", F.date_add("window_end", 1).alias("date"))
    marks = plan.join(days.unionByName(ends).distinct(), ["city_slug", "year"])
    city_year = Window.partitionBy("city_id", "city_slug", "year")
    in_order = city_year.orderBy("date")
    before = F.coalesce(F.lag("date").over(in_order), F.date_sub("window_start", 1))
    gaps = marks.select(
        "city_id",
        "city_name",
        "city_slug",
        "year",
        F.date_add(before, 1).alias("gap_start"),
        F.date_sub("date", 1).alias("gap_end"),
    ).where("gap_start <= gap_end")
    by_gap = city_year.orderBy("gap_start")
    apart = F.datediff("gap_start", F.lag("gap_end").over(by_gap)) - 1 > merge_days
    numbered = gaps.withColumn("is_new", F.coalesce(apart, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("number", F.sum("is_new").over(by_gap))
    return (
        numbered.groupBy("city_id", "city_name", "city_slug", "year", "number")
        .agg(
            F.min("gap_start").alias("window_start"),
            F.max("gap_end").alias("window_end"),
            F.sum(F.datediff("gap_end", "gap_start") + 1).cast("long").alias("missing_days"),
        )
        .drop("number")
    )


def _windows(cities: DataFrame, start: date, end: date) -> DataFrame:
    """Years are generated per city row, without a join."""
    years = F.explode(F.sequence(F.lit(start.year), F.lit(end.year)))
    first_day = F.make_date("year", F.lit(1), F.lit(1))
    last_day = F.make_date("year", F.lit(12), F.lit(31))
    return cities.select("city_id", "city_name", years.alias("year")).select(
        "city_id",
        "city_name",
        slugify(F.col("city_name")).alias("city_slug"),
        F.col("year").cast("long").alias("year"),
        F.greatest(first_day, F.lit(start)).alias("window_start"),
        F.least(last_day, F.lit(end)).alias("window_end"),
    )


def landed_summary(attempts: DataFrame, mode: str, cities: DataFrame | None = None) -> DataFrame:
    """One row on the attempts (city_name, succeeded) of a load; failed unless one succeeded.

    `total_cities` counts the rows of `cities`, which includes those that needed no attempt;
    without it, the cities attempted.

    The failed cities are a frame of their own (`failed_cities`), because a list of them inside
    this row would gather without bound in one task.
    """
    done = F.col("succeeded")
    attempted = F.count_distinct("city_name")
    total = attempted if cities is None else cities.select(F.count(F.lit(1))).scalar()
    return attempts.agg(
        total.alias("total_cities"),
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(done).alias("successes"),
        F.count_if(~done).alias("failures"),
        F.count_distinct(F.when(~done, F.col("city_name"))).alias("n_failed_cities"),
        (F.count_if(done) == 0).alias("run_failed"),
    ).select(F.lit(mode).alias("mode"), "*")


def failed_cities(attempts: DataFrame) -> DataFrame:
    """Sorted distinct names of cities with a failed attempt, with their number of failures."""
    return (
        attempts.where(~F.col("succeeded"))
        .groupBy("city_name")
        .agg(F.count(F.lit(1)).alias("failures"))
        .orderBy("city_name")
    )
