"""Running totals over a global order without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.sources.scratch import staged


def running_totals(
    frame: DataFrame, order_column: str, totals: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Add `<name>_before` for each of `totals`: its sum over all rows with a smaller order value.

    `order_column` is unique and not NULL. Spark deals the rows into ranges of it (as many as shuffle
    partitions, unless given; how even they are does not affect the result) and stores them with the
    number of their range, so the input is shuffled once and everything after reads those files. One
    sum for each range is accumulated, and a window inside each range adds the rest.
    """
    parts = ranges or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frame.repartitionByRange(parts, order_column).withColumn("_range", F.spark_partition_id())
    stored = staged(dealt, "ranges")
    in_order = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_range")
        .agg(*[F.sum(t).alias(t) for t in totals])
        .select(
            "_range",
            *[F.coalesce(F.sum(t).over(in_order), F.lit(0)).alias(f"_{t}_offset") for t in totals],
        )
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(order_column)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # `offsets` has one row for each range, whatever the size of the frame
    return (
        stored.join(F.broadcast(offsets), "_range")
        .withColumns(
            {
                f"{t}_before": F.col(f"_{t}_offset") + F.coalesce(F.sum(t).over(inside), F.lit(0))
                for t in totals
            }
        )
        .drop("_range", *[f"_{t}_offset" for t in totals])
    )
