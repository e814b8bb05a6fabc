"""Materialization points in the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders staged in the innermost `cleared` block; None outside of any.
_folders: ContextVar[list[str] | None] = ContextVar("staged_folders", default=None)


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session, else a folder beside its tables.

    The warehouse folder is where a cluster keeps tables, so all executors reach it too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/isotherm/{uuid.uuid4().hex}/{name}"


def staged(frame: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write a frame that several branches read, and go on from its files.

    This cuts the lineage and computes the upstream plan once. The files outlive executors; the
    lazy result may be read at any time, so they stay until the shared folder is emptied, or until the
    end of the `cleared` block that they were written in, unless they are `lasting`.
    """
    folder = new_folder(frame.sparkSession, name)
    if not lasting and _folders.get() is not None:
        _folders.get().append(folder)
    return _written(frame, folder)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Removes what was staged inside the block when it ends, but for lasting frames.

    For work whose result is stored as a lasting frame before the block ends.
    """
    mark = _folders.set([])
    try:
        yield
    finally:
        folders = _folders.get()
        _folders.reset(mark)
        for folder in folders:
            _removed(spark, folder)


@contextmanager
def briefly_staged(frame: DataFrame, name: str) -> Iterator[DataFrame]:
    """`staged` for work that ends inside the block; the files are removed afterwards."""
    spark = frame.sparkSession
    folder = new_folder(spark, name)
    try:
        yield _written(frame, folder)
    finally:
        _removed(spark, folder)


def _removed(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
