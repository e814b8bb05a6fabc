"""Column-to-Column helpers: text keys, calendar labels, guarded arithmetic, freshness classes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month labels, January first.
MONTH_NAMES = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)

# Meteorological season of each month, January first.
SEASONS = ("DJF", "DJF", "MAM", "MAM", "MAM", "JJA", "JJA", "JJA", "SON", "SON", "SON", "DJF")


def slugify(name: Column) -> Column:
    """Directory form of a city name: trimmed, lower case, blanks as underscores."""
    return F.replace(F.lower(F.trim(name)), F.lit(" "), F.lit("_"))


def path_segment(path: Column, from_end: int) -> Column:
    """The n-th path segment counted from the end (1 = file name), NULL when the path is shorter.

    `_metadata.file_path` is percent-encoded. A literal plus sign is protected first because
    `url_decode` would read it as a blank.
    """
    segment = F.try_element_at(F.split(path, "/"), F.lit(-from_end))
    return F.try_url_decode(F.replace(segment, F.lit("+"), F.lit("%2B")))


def _nth_label(month: Column, labels: tuple[str, ...]) -> Column:
    known = month.between(1, len(labels))
    return F.when(known, F.element_at(F.array(*[F.lit(x) for x in labels]), month.cast("int")))


def month_name(month: Column) -> Column:
    return _nth_label(month, MONTH_NAMES)


def season(month: Column) -> Column:
    return _nth_label(month, SEASONS)


def month_index(year: Column, month: Column) -> Column:
    """Months on one integer axis, so that calendar distance is a subtraction."""
    return (year * 12 + month).cast("long")


def flag(condition: Column) -> Column:
    """0/1 form of a condition; an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def truth(condition: Column) -> Column:
    """Boolean form of a condition; an unknown condition counts as FALSE."""
    return F.coalesce(condition, F.lit(False))


def standardize(deviation: Column, spread: Column) -> Column:
    """deviation / spread, NULL unless the spread is known and positive."""
    return F.when(spread > 0, deviation / spread)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def logistic(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def freshness(last_date: Column, as_of: date, fresh_days: int = 1, stale_days: int = 7) -> Column:
    """fresh / stale / very_stale by days behind `as_of`; unknown when there is no date."""
    behind = F.datediff(F.lit(as_of), last_date)
    return (
        F.when(last_date.isNull(), F.lit("unknown"))
        .when(behind <= fresh_days, F.lit("fresh"))
        .when(behind <= stale_days, F.lit("stale"))
        .otherwise(F.lit("very_stale"))
    )
