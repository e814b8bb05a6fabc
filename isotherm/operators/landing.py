"""From raw nested documents to the keyed daily table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.config import DAILY_VARIABLES
from isotherm.functions.columns import path_segment, slugify
from isotherm.schemas import CORRUPT_COLUMN

# The slug is part of the key so that days of unknown cities (NULL id) stay apart.
LANDING_KEYS = ("city_id", "city_slug", "date")
# Key columns that stay NULL until the dimension knows the city.
RESOLVED_LATER = ("city_id",)
# Columns that the dimension gives to a city, hence the same in all rows of a key.
KEY_LABELS = ("city_name", "country_code")


def with_city_slug(raw: DataFrame) -> DataFrame:
    """City slug = name of the directory that holds the document."""
    if "city_slug" in raw.columns:
        return raw
    return raw.withColumn("city_slug", path_segment(F.col("file_path"), 2))


def validate_raw(raw: DataFrame, variables: Sequence[str] = DAILY_VARIABLES) -> DataFrame:
    """Add `n_records` and `errors` to each document; an empty `errors` array means valid.

    Purely per document, no shuffle. A key that is absent and a key that holds something other
    than an array both arrive as NULL under the explicit schema.
    """
    daily, time = F.col("daily"), F.col("daily.time")
    n = F.size(time)

    findings = [
        F.when(daily.isNull(), F.lit("missing daily")),
        F.when(daily.isNotNull() & time.isNull(), F.lit("missing daily.time")),
        F.when(n == 0, F.lit("empty daily.time")),
        F.when(F.exists(time, lambda day: day.try_cast("date").isNull()), F.lit("bad daily.time")),
    ]
    if CORRUPT_COLUMN in raw.columns:
        findings.insert(0, F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("unreadable document")))
    for name in variables:
        series = F.col(f"daily.{name}")
        findings.append(F.when(time.isNotNull() & series.isNull(), F.lit(f"missing daily.{name}")))
        findings.append(
            F.when(
                F.size(series) != n,
                F.concat(
                    F.lit(f"length of daily.{name}: expected "), n, F.lit(", got "), F.size(series)
                ),
            )
        )
    return raw.withColumns(
        {
            "n_records": F.coalesce(F.when(time.isNotNull(), n), F.lit(0)).cast("long"),
            "errors": F.array_compact(F.array(*findings)),
        }
    )


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents to load, and documents for the quarantine table."""
    clean = F.size("errors") == 0
    return validated.where(clean).drop("errors"), validated.where(~clean)


def flatten_daily(raw: DataFrame, variables: Sequence[str] = DAILY_VARIABLES) -> DataFrame:
    """Parallel arrays to one row per day.

    `time` alone decides how many days a document has: shorter variables end in NULLs, longer
    ones are cut, an absent one is all NULL. A load-order column of the reader passes through.
    """
    raw = with_city_slug(raw)
    used = ("daily", "n_records", "errors", "file_path", "year", CORRUPT_COLUMN)
    kept = [c for c in raw.columns if c not in used]
    n = F.greatest(F.size("daily.time"), F.lit(0))
    absent = F.array_repeat(F.lit(None).cast("double"), n)
    zipped = F.arrays_zip(
        F.col("daily.time").alias("time"),
        *[F.coalesce(F.slice(f"daily.{v}", F.lit(1), n), absent).alias(v) for v in variables],
    )
    date = F.col("time").cast("date")
    return raw.select(*kept, F.inline(zipped)).select(
        *kept, F.year(date).cast("long").alias("year"), date.alias("date"), *variables
    )


def attach_city(daily: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Left join to the city dimension on the slug of its name; unknown slugs keep a NULL city.

    The dimension grows with the fleet, so it is broadcast only if the optimizer finds it small;
    otherwise the join is a shuffle whose hot slugs adaptive execution splits.
    """
    cities = dim_city.select(
        "city_id", "city_name", "country_code", slugify(F.col("city_name")).alias("city_slug")
    )
    joined = daily.join(cities, "city_slug", "left")
    first = ["city_id", "city_name", "country_code", "city_slug"]
    return joined.select(*first, *[c for c in daily.columns if c not in first])


def newest_per_key(
    rows: DataFrame, keys: Sequence[str] = LANDING_KEYS, order_by: str | None = None
) -> DataFrame:
    """One row per key: the newest by `order_by` (a timestamp or whole number), ties and the case
    without it by content, so repeatably.

    An aggregate instead of a ranking window, so that repeated deliveries of one key collapse
    before the shuffle. Names follow from the key and are grouped with it; what is left has a
    fixed width, which keeps this a hash aggregate. All columns of a key come from one row,
    because each of them is chosen by the same comparisons.
    """
    grouped = [c for c in rows.columns if c in keys or c in KEY_LABELS]
    values = [c for c in rows.columns if c not in grouped]
    order = F.xxhash64(*values)
    if order_by:
        # ties of the load order go by content, so the order of tasks does not show
        kind = dict(rows.dtypes)[order_by]
        moment = F.unix_micros(order_by) if kind == "timestamp" else F.col(order_by)
        content = F.pmod(order, F.lit(1 << 30)).cast("decimal(10,0)")
        order = moment.cast("decimal(20,0)") * F.lit(1 << 30).cast("decimal(10,0)") + content
    newest = rows.groupBy(*grouped).agg(*[F.max_by(c, order).alias(c) for c in values])
    return newest.select(*rows.columns)


def land_incremental(
    new: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str] = LANDING_KEYS,
    mode: Literal["upsert", "high_watermark"] = "upsert",
    order_by: str | None = None,
) -> DataFrame:
    """The daily table after loading `new`.

    `high_watermark` accepts only dates beyond the newest one already present, over all cities.
    `upsert` (default) lets an incoming row replace the stored row of its key, which also takes
    late cities and corrections. A missing target takes everything.
    """
    if mode not in ("upsert", "high_watermark"):
        raise ValueError(f"unknown mode: {mode}")
    if target is None:
        return newest_per_key(new, keys, order_by).drop(order_by or "")
    if mode == "high_watermark":
        return target.unionByName(beyond_watermark(new, target, keys, order_by))
    return replace_rows(newest_per_key(new, keys, order_by).select(*target.columns), target, keys)


def beyond_watermark(
    new: DataFrame, target: DataFrame, keys: Sequence[str] = LANDING_KEYS, order_by: str | None = None
) -> DataFrame:
    """Incoming rows dated after everything stored; nothing passes an empty target."""
    fresh = new.where(F.col("date") > target.select(F.max("date")).scalar())
    return newest_per_key(fresh, keys, order_by).select(*target.columns)


def replace_rows(
    incoming: DataFrame, target: DataFrame, keys: Sequence[str] = LANDING_KEYS
) -> DataFrame:
    """Stored rows whose key does not come in again, plus the incoming rows.

    A day that was stored for an unknown city (NULL id) gives way to the same day of its slug,
    so a load after the dimension has learned the city leaves no second copy.
    """
    same = F.lit(True)
    for key in keys:
        old, new = F.col(f"old.{key}"), F.col(f"new.{key}")
        equal = old.eqNullSafe(new)
        same = same & ((equal | old.isNull()) if key in RESOLVED_LATER else equal)
    kept = target.alias("old").join(incoming.select(*keys).alias("new"), same, "left_anti")
    return kept.unionByName(incoming)
