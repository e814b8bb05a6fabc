"""Raw documents as a data source: listed by many tasks, written file by file, streamed by modification time.

    <root>/<city slug>/<year>.json

Spark's file source lists such a tree on the driver and remembers every path that a stream has seen, so
a year-to-date file that is written again is never read again. Here a task lists the directories of its
share of the slugs, and a stream's offset is a moment: a batch holds the files modified after the last
one. The file system is whatever pyarrow opens for the root's scheme.
"""

from __future__ import annotations

import sys
import time
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from isotherm.config import DAILY_VARIABLES
from isotherm.schemas import CORRUPT_COLUMN, raw_document_schema

# The source's classes travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "landing_zone"
SCHEMA = "city_slug string, year bigint, file_path string, modified_at timestamp, document string"
_ARROW = pa.schema(
    [
        ("city_slug", pa.string()),
        ("year", pa.int64()),
        ("file_path", pa.string()),
        ("modified_at", pa.timestamp("us", tz="UTC")),
        ("document", pa.string()),
    ]
)

#: Files of one Arrow batch.
BATCH_FILES = 64


def opened(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a root, with or without a scheme."""
    if "://" not in root and ":/" in root:  # file:/x, as Hadoop writes it
        scheme, path = root.split(":", 1)
        root = f"{scheme}://{path}"
    if "://" not in root:
        return pafs.LocalFileSystem(), root.rstrip("/")
    system, path = pafs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


@dataclass
class Share(InputPartition):
    """The slugs with one remainder of their checksum, and the moments (microseconds) after and up to which files count."""

    number: int
    shares: int
    after: int
    until: int


class _Files:
    """Reading one share of a zone."""

    def __init__(self, options: dict):
        self.root = options["path"]
        self.shares = max(1, int(options.get("shares", "8")))
        self.with_documents = options.get("documents", "true").lower() == "true"

    def shares_of(self, after: int, until: int) -> list[Share]:
        return [Share(k, self.shares, after, until) for k in range(self.shares)]

    def listed(self, share: Share) -> Iterator[tuple[str, int | None, str, int]]:
        """Slug, year, path and modification of the files of a share; hidden files are none."""
        system, base = opened(self.root)
        if system.get_file_info(base).type != pafs.FileType.Directory:
            return
        for folder in system.get_file_info(pafs.FileSelector(base)):
            name = folder.base_name
            if folder.type != pafs.FileType.Directory or name.startswith(("_", ".")):
                continue
            if zlib.crc32(name.encode()) % share.shares != share.number:
                continue
            for file in system.get_file_info(pafs.FileSelector(folder.path, allow_not_found=True)):
                stem, dot, kind = file.base_name.rpartition(".")
                if file.type != pafs.FileType.File or kind != "json" or file.base_name.startswith(("_", ".")):
                    continue
                moment = file.mtime_ns // 1000
                if share.after < moment <= share.until:
                    yield name, int(stem) if stem.isdecimal() else None, file.path, moment

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.root)
        rows: list[tuple] = []
        for slug, year, path, moment in self.listed(share):
            document = None
            if self.with_documents:
                with system.open_input_stream(path) as stream:
                    document = stream.read().decode(errors="replace")
            rows.append((slug, year, path, moment, document))
            if len(rows) >= BATCH_FILES:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)


class ZoneReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = _Files(options)

    def partitions(self) -> list[Share]:
        return self.files.shares_of(-1, 1 << 62)

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return self.files.read(partition)


class ZoneStream(DataSourceStreamReader):
    """Batches of the files modified between two moments.

    `settle_seconds` keeps the newest moments back, for storage whose clock runs late. A file that is
    written again while a batch is read belongs to the next batch.
    """

    def __init__(self, options: dict):
        self.files = _Files(options)
        self.settle = int(float(options.get("settle_seconds", "0")) * 1e6)

    def initialOffset(self) -> dict:  # noqa: N802 - the interface's name
        return {"until": -1}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"until": time.time_ns() // 1000 - self.settle}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        return self.files.shares_of(start["until"], end["until"])

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return self.files.read(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept for batches that are done."""


@dataclass
class Written(WriterCommitMessage):
    files: int


class ZoneWriter(DataSourceArrowWriter):
    """One file for each row (city_slug, year, document); a file of the same name is replaced at once."""

    def __init__(self, options: dict):
        self.root = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, base = opened(self.root)
        count = 0
        for batch in batches:
            for slug, year, document in zip(*[batch.column(c).to_pylist() for c in ("city_slug", "year", "document")]):
                system.create_dir(f"{base}/{slug}", recursive=True)
                hidden = f"{base}/{slug}/_{uuid.uuid4().hex}"
                with system.open_output_stream(hidden) as stream:
                    stream.write(document.encode())
                system.move(hidden, f"{base}/{slug}/{year}.json")
                count += 1
        return Written(count)


class LandingZone(DataSource):
    """`format("landing_zone")`; options `shares` (tasks that list) and `documents` (false: names only)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZoneReader:
        return ZoneReader(dict(self.options))

    def streamReader(self, schema) -> ZoneStream:  # noqa: N802 - the interface's name
        return ZoneStream(dict(self.options))

    def writer(self, schema, overwrite) -> ZoneWriter:
        return ZoneWriter(dict(self.options))


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(LandingZone)
    return spark


def _parsed(files: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Documents parsed by Spark, as `readers.read_raw_daily` gives them, with slug and year of their path."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = F.from_json("document", raw_document_schema(variables), options)
    return files.withColumn("parsed", parsed).select(
        "parsed.daily", f"parsed.{CORRUPT_COLUMN}", "city_slug", "year", "file_path", "modified_at"
    )


def list_documents(spark: SparkSession, root: str, shares: int = 8) -> DataFrame:
    """city_slug, year, file_path and modified_at of all documents; no file is opened."""
    reader = _registered(spark).read.format(NAME).option("shares", shares).option("documents", "false")
    return reader.load(root).drop("document")


def read_documents(
    spark: SparkSession, root: str, variables: Sequence[str] = DAILY_VARIABLES, shares: int = 8
) -> DataFrame:
    """All documents of a zone."""
    return _parsed(_registered(spark).read.format(NAME).option("shares", shares).load(root), variables)


def documents_at(listing: DataFrame, root: str, variables: Sequence[str] = DAILY_VARIABLES) -> DataFrame:
    """The documents of a listing (as from `list_documents`), opened by the tasks that hold its rows."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(root)
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_FILES):
                part = batch.slice(begin, BATCH_FILES)
                texts = []
                for path in part.column("file_path").to_pylist():
                    with system.open_input_stream(path) as stream:
                        texts.append(stream.read().decode(errors="replace"))
                columns = [part.column(c) for c in ("city_slug", "year", "file_path", "modified_at")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema=_ARROW)

    wanted = listing.select("city_slug", "year", "file_path", "modified_at")
    return _parsed(wanted.mapInArrow(fetch, SCHEMA), variables)


def documents_stream(
    spark: SparkSession,
    root: str,
    variables: Sequence[str] = DAILY_VARIABLES,
    shares: int = 8,
    settle_seconds: float = 0,
) -> DataFrame:
    """The documents of a zone as a stream, files that are written again included."""
    reader = _registered(spark).readStream.format(NAME).option("shares", shares)
    return _parsed(reader.option("settle_seconds", settle_seconds).load(root), variables)


def write_documents(documents: DataFrame, root: str) -> None:
    """One JSON file for each document (daily, city_slug, year), in place of an earlier one of its name."""
    _registered(documents.sparkSession)
    rows = documents.select("city_slug", F.col("year").cast("bigint").alias("year"), F.to_json(F.struct("daily")).alias("document"))
    rows.write.format(NAME).mode("append").save(root)
