"""New raw documents, validated, flattened and upserted as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from isotherm.config import DAILY_VARIABLES
from isotherm.operators.landing import (
    attach_city,
    flatten_daily,
    split_valid,
    validate_raw,
    with_city_slug,
)
from isotherm.sources.readers import landed_documents_stream, raw_daily_stream
from isotherm.sources.scratch import briefly_staged
from isotherm.sources.writers import load_daily
from isotherm.sources.zone import documents_stream


def stream_landing(
    spark: SparkSession,
    root: str,
    dim_city: DataFrame,
    table_path: str,
    quarantine_path: str,
    checkpoint: str,
    variables: Sequence[str] = DAILY_VARIABLES,
    max_files_per_batch: int = 100_000,
) -> StreamingQuery:
    """Start a run over all `<slug>/<year>.json` files not seen yet; it ends when they are loaded.

    Each micro-batch is a keyed upsert, so replaying one after a failure changes nothing. A file
    source notices new paths only: `stream_zone` reads rewritten files again.
    """
    documents = raw_daily_stream(spark, root, variables, max_files_per_batch)
    return _start(documents, dim_city, table_path, quarantine_path, checkpoint, variables)


def stream_landed_documents(
    spark: SparkSession,
    root: str,
    dim_city: DataFrame,
    table_path: str,
    quarantine_path: str,
    checkpoint: str,
    variables: Sequence[str] = DAILY_VARIABLES,
    max_files_per_batch: int = 100_000,
) -> StreamingQuery:
    """The same over a landing zone written by `writers.land_documents`."""
    documents = landed_documents_stream(spark, root, variables, max_files_per_batch)
    return _start(documents, dim_city, table_path, quarantine_path, checkpoint, variables)


def stream_zone(
    spark: SparkSession,
    root: str,
    dim_city: DataFrame,
    table_path: str,
    quarantine_path: str,
    checkpoint: str,
    variables: Sequence[str] = DAILY_VARIABLES,
    shares: int = 8,
    settle_seconds: float = 0,
) -> StreamingQuery:
    """The same over `<slug>/<year>.json` files by their time of modification.

    A file that was written again since the last run is read again, which a path-based source would
    not notice; the newer file wins each day.
    """
    documents = documents_stream(spark, root, variables, shares, settle_seconds)
    return _start(documents, dim_city, table_path, quarantine_path, checkpoint, variables)


def _start(
    documents: DataFrame,
    dim_city: DataFrame,
    table_path: str,
    quarantine_path: str,
    checkpoint: str,
    variables: Sequence[str],
) -> StreamingQuery:
    def load(batch: DataFrame, batch_id: int) -> None:
        # parsed once, read by the load and by the quarantine
        with briefly_staged(validate_raw(batch, variables), "documents") as documents:
            good, bad = split_valid(documents)
            days = attach_city(flatten_daily(good, variables), dim_city)
            load_daily(days, table_path, order_by="modified_at")
            # one folder per batch, overwritten on replay
            bad.select("city_slug", "modified_at", "n_records", "errors").write.mode(
                "overwrite"
            ).parquet(f"{quarantine_path}/batch={batch_id}")

    return (
        with_city_slug(documents)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
