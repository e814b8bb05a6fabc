"""Daily deliveries as a keyed stream: only what is newer than everything before passes, and is appended.

The state of a city's year is one value: for each of its days the moment of the newest delivery. A
delivered year costs one read and one write of state, and a micro-batch appends the days that are news
instead of rewriting the years of a table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from isotherm.operators.landing import LANDING_KEYS, newest_per_key

# The processor travels with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The state store that keyed state with a time limit needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DAYS = 366
NEVER = np.iinfo(np.int64).min


class NewestDays(StatefulProcessor):
    """Passes the rows of a city's year (`date`, `moment`, `content`) that are newer than all before.

    Of one day's rows in a batch the newest passes, ties by content; a row as old as the stored moment
    or older is a repeat or too late. `keep_ms` after its last change a year's state is forgotten, and
    a delivery then passes again; readers of the log take the newest row of a day anyway.
    """

    def __init__(self, keep_ms: int | None = None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "moments binary", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows), ignore_index=True)
        stored = self.newest.get() if self.newest.exists() else None
        moments = np.full(DAYS, NEVER, np.int64) if stored is None else np.frombuffer(stored[0], np.int64).copy()
        batch = batch.sort_values(["moment", "content"], kind="stable").drop_duplicates("date", keep="last")
        day = pd.to_datetime(batch["date"]).dt.dayofyear.to_numpy() - 1
        moment = batch["moment"].to_numpy(np.int64)
        fresh = moment > moments[day]
        if fresh.any():
            moments[day[fresh]] = moment[fresh]
            self.newest.update((moments.tobytes(),))
            yield batch[fresh]

    def close(self) -> None:
        pass


def newest_days(days: DataFrame, order_by: str = "modified_at", keep_ms: int | None = None) -> DataFrame:
    """The rows of a stream of days that are newer, by `order_by`, than every earlier one of their key.

    `days` has city_slug, year and date without nulls; `order_by` is a timestamp or a whole number.
    """
    kind = dict(days.dtypes)[order_by]
    moment = F.unix_micros(order_by) if kind == "timestamp" else F.col(order_by).cast("bigint")
    marked = days.withColumns({"moment": moment, "content": F.xxhash64(*days.columns)})
    return (
        marked.groupBy("city_slug", "year")
        .transformWithStateInPandas(
            statefulProcessor=NewestDays(keep_ms),
            outputStructType=marked.schema,
            outputMode="Append",
            timeMode="None" if keep_ms is None else "ProcessingTime",
        )
        .drop("moment", "content")
    )


def append_newest_days(
    days: DataFrame,
    log_path: str,
    checkpoint: str,
    order_by: str = "modified_at",
    keep_ms: int | None = None,
    every: str = "1 minute",
) -> StreamingQuery:
    """Start a run that appends the new days of a stream to a log partitioned by year.

    It ends when all is read. With a time limit it goes on until it is stopped, with a batch `every`
    so often, because state runs out with time and not with data.
    """
    spark = days.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = (
        newest_days(days, order_by, keep_ms)
        .writeStream.format("parquet")
        .partitionBy("year")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if keep_ms is None else writer.trigger(processingTime=every)
    return writer.start(log_path)


def current_days(
    spark: SparkSession, log_path: str, keys: Sequence[str] = LANDING_KEYS, order_by: str = "modified_at"
) -> DataFrame:
    """The daily table that a log stands for: the newest row of each key."""
    log = spark.read.parquet(log_path).withColumn("year", F.col("year").cast("bigint"))
    return newest_per_key(log, keys, order_by).drop(order_by)
