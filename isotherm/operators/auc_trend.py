"""ROC-AUC as a trend: mergeable quantile sketches of the scores, by class and period.

A period's scores are reduced to one sketch for each class, which merge into longer periods without
the scores. The area comes from quantiles of both classes; its error is bounded by the sketches' rank
errors and the number of quantiles. `ml.roc_auc` is the exact form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.config import TARGET_COLUMN

PROBABILITY = "prob_event_next_month"

#: Accuracy parameter of a sketch, and ranks at which either class is read off.
SKETCH_K = 800
POINTS = 250


def rank_error(k: int = SKETCH_K) -> float:
    """Rank error of a sketch that 99 of 100 stay within."""
    return 2.296 / k**0.9723  # fixed values of the sketch's published error


def score_sketches(
    scored: DataFrame, by: Sequence[str], label: str = TARGET_COLUMN, score: str = PROBABILITY, k: int = SKETCH_K
) -> DataFrame:
    """One row for each period: count and sketch of the scores of either class. Rows without label or score do not count."""
    value, positive = F.col(score).cast("double"), F.col(label) == 1
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(*by).agg(
        F.count_if(positive).alias("n_positive"),
        F.count_if(~positive).alias("n_negative"),
        F.kll_sketch_agg_double(F.when(positive, value), k).alias("positives"),
        F.kll_sketch_agg_double(F.when(~positive, value), k).alias("negatives"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """The sketches of longer periods from those of shorter ones."""
    return sketches.groupBy(*by).agg(
        F.sum("n_positive").alias("n_positive"),
        F.sum("n_negative").alias("n_negative"),
        F.kll_merge_agg_double("positives", k).alias("positives"),
        F.kll_merge_agg_double("negatives", k).alias("negatives"),
    )


def auc_trend(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """The sketches' periods with `roc_auc`, NULL unless both classes are present, and its `error_bound`.

    Both classes are read off at `POINTS` evenly spaced ranks, and the area is the share of pairs of
    such points that are ranked right; ties count half.
    """
    both = (F.col("n_positive") > 0) & (F.col("n_negative") > 0)
    ranks = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    points = [F.kll_sketch_get_quantile_double(F.when(both, F.col(c)), ranks).alias(c) for c in ("positives", "negatives")]
    keys = [c for c in sketches.columns if c not in ("positives", "negatives")]

    def beaten(x: Column) -> Column:
        below = F.size(F.filter("negatives", lambda y: y < x))
        return below + F.size(F.filter("negatives", lambda y: y == x)) / 2

    area = F.aggregate("positives", F.lit(0.0), lambda total, x: total + beaten(x)) / (POINTS * POINTS)
    bound = F.lit(2 * rank_error(k) + 2 / POINTS)
    return sketches.select(*keys, *points).select(*keys, area.alias("roc_auc"), F.when(both, bound).alias("error_bound"))
