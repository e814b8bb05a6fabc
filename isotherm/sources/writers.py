"""Sinks: full refresh, views, incremental load, logs, predictions, models, landing zone."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.operators.landing import (
    LANDING_KEYS,
    beyond_watermark,
    newest_per_key,
    replace_rows,
)
from isotherm.operators.observe import with_next_ids
from isotherm.sources.readers import landed_windows, read_table, table_exists
from isotherm.sources.scratch import briefly_staged


def write_table(
    frame: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Full refresh of a stored table, returned as a scan of what was written.

    Rows are ordered within files only; a global order would cost a range shuffle. Rows of one
    table partition are brought together first, so that each is a few files. The new table is
    complete before the old one goes, so a run that dies leaves one of them, and `frame` may read
    the table that it replaces.
    """
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    if sort_by:
        frame = frame.sortWithinPartitions(*partition_by, *sort_by)
    path = path.rstrip("/")
    beside = f"{path}__new_{uuid.uuid4().hex}"
    frame.write.partitionBy(*partition_by).parquet(beside)
    _put_in_place(frame.sparkSession, beside, path)
    return frame.sparkSession.read.parquet(path)


def _put_in_place(spark: SparkSession, new: str, path: str) -> None:
    """Rename a finished folder to `path`; what was there is renamed first and removed last."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{new}_old"
    if system.exists(folder(path)) and not system.rename(folder(path), folder(old)):
        raise OSError(f"could not move {path} away")
    if not system.rename(folder(new), folder(path)):
        raise OSError(f"could not move {new} to {path}; the earlier table is {old}")
    system.delete(folder(old), True)
    spark.catalog.refreshByPath(path)


def publish_view(frame: DataFrame, name: str) -> DataFrame:
    """A logical view; nothing is computed."""
    frame.createOrReplaceTempView(name)
    return frame


def load_daily(
    new: DataFrame,
    path: str,
    keys: Sequence[str] = LANDING_KEYS,
    mode: Literal["upsert", "high_watermark"] = "upsert",
    order_by: str | None = "modified_at",
) -> DataFrame:
    """Load `new` into the stored daily table, which is partitioned by year.

    `high_watermark` only appends. `upsert` reads and rewrites just the years that `new` touches;
    dynamic overwrite leaves every other year as it is. A job that dies half-way can be run again.
    """
    spark = new.sparkSession
    order_by = order_by if order_by in new.columns else None
    if mode == "upsert":
        upsert_daily(new, path, keys, order_by)
        return spark.read.parquet(path)
    if mode != "high_watermark":
        raise ValueError(f"unknown mode: {mode}")
    if not table_exists(spark, path):
        fresh = newest_per_key(new, keys, order_by).drop(order_by or "")
    else:
        stored = spark.read.parquet(path).withColumn("year", F.col("year").cast("long"))
        fresh = beyond_watermark(new, stored, keys, order_by)
    _by_year(fresh).write.mode("append").partitionBy("year").parquet(path)
    return spark.read.parquet(path)


def upsert_daily(
    new: DataFrame, path: str, keys: Sequence[str] = LANDING_KEYS, order_by: str | None = None
) -> list[int]:
    """The upsert of `load_daily`; returns the years it has rewritten.

    The years come to the driver (their number is bounded by the calendar) and are a filter on the
    partition column, so no other year of the stored table is read.
    """
    spark = new.sparkSession
    order_by = order_by if order_by in new.columns else None
    rows = newest_per_key(new, keys, order_by).drop(order_by or "")
    with briefly_staged(rows, "incoming") as incoming:
        found = [r["year"] for r in incoming.select("year").distinct().collect()]
        years = sorted(found, key=lambda y: (y is None, y))
        if not table_exists(spark, path):
            _by_year(incoming).write.mode("append").partitionBy("year").parquet(path)
            return years
        if years:
            stored = of_years(spark.read.parquet(path), years)
            incoming = incoming.select(*stored.columns)
            _by_year(replace_rows(incoming, stored, keys)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("year").parquet(path)
    return years


def of_years(table: DataFrame, years: Sequence[int]) -> DataFrame:
    """Rows of some years (None: without one) of a table that is partitioned by year."""
    wanted = F.col("year").isin([y for y in years if y is not None])
    if None in years:
        wanted = wanted | F.col("year").isNull()
    return table.where(wanted).withColumn("year", F.col("year").cast("long"))


def _by_year(rows: DataFrame) -> DataFrame:
    """Rows of one year side by side, so that each task writes few files.

    Adaptive execution splits the years that are too large for one task.
    """
    return rows.hint("rebalance", "year")


def land_documents(documents: DataFrame, root: str, mode: Literal["backfill", "recent"]) -> None:
    """Write documents (daily, city_slug, year) into the landing zone, one directory per key.

    `backfill` leaves windows alone that are already landed; `recent` replaces exactly the
    windows delivered.
    """
    if mode == "backfill":
        present = landed_windows(documents.sparkSession, root, partitioned=True)
        documents = documents.join(present, ["city_slug", "year"], "left_anti")
        writer = documents.write.mode("append")
    elif mode == "recent":
        writer = documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        raise ValueError(f"unknown mode: {mode}")
    writer.partitionBy("city_slug", "year").json(root)


def append_log(
    rows: DataFrame, path: str, schema: T.StructType, order_by: str | None = None
) -> DataFrame:
    """Append rows without id to a log table; ids continue after the highest stored one.

    `order_by` is a unique numeric column to number a batch by.
    """
    spark = rows.sparkSession
    stored = read_table(spark, path, schema, required=False)
    # stored rows keep the order in which they are numbered
    with briefly_staged(rows, "log_rows") as batch:
        numbered = with_next_ids(batch, stored, order_by).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        )
        numbered.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def write_predictions(predictions: DataFrame, table_path: str, csv_path: str) -> DataFrame:
    """Replace the predictions table, then export the stored rows as CSV with a header."""
    stored = write_table(predictions, table_path)
    stored.write.mode("overwrite").option("header", True).csv(csv_path)
    return stored


def write_metrics_document(record: DataFrame, path: str) -> None:
    """The metrics record as a JSON document."""
    record.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A stored model; a missing one is a FileNotFoundError."""
    try:
        return PipelineModel.load(path)
    except AnalysisException as problem:
        raise FileNotFoundError(f"model not found: {path}") from problem
