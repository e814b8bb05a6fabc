"""WARC archives of pages: records compressed one by one with a Zstandard dictionary of their own.

An archive is a folder of files that any Zstandard reader with the dictionary can read as WARC:

    skippable frame 0x184D2A5D     the dictionary, the first frame of every file
    frame                          a `warcinfo` record
    frame, frame, ...              one record each

Between two frames stands a skippable frame with the archive's mark, a random text. Zstandard readers pass
over it; Spark's own text files use it as the line separator, so files are written by Spark's writer with
its commit, to any file system it knows, and read back in splits.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Payloads from this size on are stored once; shorter ones are repeated.
REVISIT_BYTES = 1000

#: The dictionary is fitted on the records of this many pages, the ones with the least hash of their
#: payload among those of at most `FIT_PAGE_BYTES`, so the driver holds at most 16 MB of them.
FIT_PAGES = 512
FIT_PAGE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10

LEVEL = 6

#: Record bytes that wait before they go on to the writer.
STEP_BYTES = 1 << 20

# fixed values of the Zstandard format and of its WARC profile
DICTIONARY_MAGIC = 0x184D2A5D
MARK_MAGIC = 0x184D2A50
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def new_mark() -> str:
    """A line separator that is a skippable frame: printable characters, 122 of its bits random."""
    return skippable(MARK_MAGIC, uuid.uuid4().hex.encode()).decode()


@dataclass(frozen=True)
class Dictionary:
    """Bytes of a dictionary; empty: records are compressed without one."""

    content: bytes

    @staticmethod
    def fitted(samples: list[bytes], size: int = DICTIONARY_BYTES) -> Dictionary:
        """Trained on the samples; too few for that give the last of them as they are."""
        try:
            return Dictionary(zstandard.train_dictionary(size, samples).as_bytes())
        except zstandard.ZstdError:
            return Dictionary(b"".join(samples)[-size:])

    def _data(self) -> zstandard.ZstdCompressionDict | None:
        return zstandard.ZstdCompressionDict(self.content) if len(self.content) >= 8 else None

    def compressor(self) -> zstandard.ZstdCompressor:
        data = self._data()
        if data is not None:
            data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True, write_content_size=True)

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=self._data())


def _header_value(text: str) -> str:
    """A text as a header's value: what is not printable ASCII becomes percent escapes."""
    return quote(text, safe="".join(map(chr, range(33, 127))))


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr(parts).encode()).digest()[:16], version=5)}>"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, date: str, copy: int = 0, refers_to: tuple | None = None
) -> bytes:
    """A response, or with `refers_to` (the response's page_id, or None, in a tuple) a revisit without its payload."""
    kind = "response" if refers_to is None else "revisit"
    headers = [
        ("WARC-Record-ID", _record_id(kind, page_id, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _header_value(url) if url else "urn:page:" + ("" if page_id is None else str(page_id))),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    if url is None:
        headers.append(("Page-URL", "none"))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _record_id("response", refers_to[0], digest, 0)),
        ]
        if refers_to[0] is not None:
            headers.append(("Refers-To-Page-ID", str(refers_to[0])))
    headers.append(("Content-Type", "application/http;msgtype=response"))
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return record(kind, headers, answer.encode() + (payload if refers_to is None else b""))


def parse(raw: bytes) -> dict | None:
    """Fields of a page's record, its payload among them; None for other records. Damage raises."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} has not the length it states")
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    answer, _, payload = rest[:-4].partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of record {fields['WARC-Record-ID']} is damaged")
    page, target = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
    return {
        "page_id": None if page is None else int(page),
        "url": None if "Page-URL" in fields else fields["WARC-Target-URI"],
        "payload_bytes": int(_LENGTH.search(answer + b"\r\n")[1]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if target is None else int(target),
        "payload": payload if kind == "response" else None,
    }


def _payloads(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("bigint").alias("size")
    )


def _fitted(payloads: DataFrame) -> Dictionary:
    """The dictionary of an archive, from a bounded sample of its records.

    Digests are spread evenly, so the payloads under a share of their range are twice the number
    wanted, each once; only those meet.
    """
    small = payloads.where(F.col("size") <= FIT_PAGE_BYTES)
    known = small.agg(F.approx_count_distinct("digest")).first()[0]
    limit = f"{min(0xFFFFFFFF, (2 * FIT_PAGES << 32) // max(1, known)):08x}"
    few = small.where(F.substring("digest", 1, 8) <= limit).groupBy("digest")
    rows = few.agg(F.first("payload").alias("payload"), F.max("url").alias("url")).orderBy("digest").limit(FIT_PAGES).collect()
    date = "2000-01-01T00:00:00Z"
    return Dictionary.fitted([page_record(0, r["url"], bytes(r["payload"]), r["digest"], date) for r in rows])


def write_archive(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record for each row of `pages` (page_id, url, html) into the archive `folder`.

    The payload is the html in UTF-8. Of the rows with equal payloads of `REVISIT_BYTES` or more, the
    one with the largest page_id is a response and the others are revisits that refer to it; shorter
    payloads are all responses. Null or empty html: an empty payload. A null page_id counts as the
    smallest, and a record of it names no page. Rows that share the largest page_id and the payload:
    one of them is the response. A null URL is read back as null, characters that a header cannot
    hold come back as percent escapes. Other columns are not read; an empty table gives an archive without records.

    Equal payloads are counted by digest and a salt of the page's id before they are put together,
    and learn their response by digest and salt, so copies with a third of all rows spread over as
    many tasks as there are partitions. Texts move once; a file holds what one task gets.
    """
    spark = pages.sparkSession
    payloads = _payloads(pages)
    dictionary = _fitted(payloads)
    mark = new_mark()
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = payloads.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    counted = (
        salted.where(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest", "size", "salt")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("rows"))
    )
    shared = (
        counted.groupBy(F.col("digest").alias("d"), F.col("size").alias("s"))
        .agg(F.max("last").alias("holder"), F.sum("rows").alias("all_rows"))
        .where("all_rows > 1")
    )
    known = counted.join(shared, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s"))).select(
        "digest", "size", "salt", "holder", F.lit(True).alias("shared")
    )
    same = Window.partitionBy("digest", "size", "salt").orderBy(F.col("page_id").desc_nulls_last())
    rows = (
        salted.join(known.hint("merge"), ["digest", "size", "salt"], "left")
        .withColumn("place", F.row_number().over(same))
        .select(
            "page_id",
            "url",
            "payload",
            "digest",
            "place",
            "holder",
            (F.col("shared").isNotNull() & ~((F.col("place") == 1) & F.col("page_id").eqNullSafe(F.col("holder")))).alias("revisit"),
        )
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = dictionary.compressor()
        held, size = [skippable(DICTIONARY_MAGIC, dictionary.content)], 0
        about = b"software: isotherm\r\nformat: WARC File Format 1.1\r\n"
        headers = [("WARC-Record-ID", _record_id("info", mark)), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
        held.append(compressor.compress(record("warcinfo", headers, about)))
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "place", "holder", "revisit")]
            for k in range(batch.num_rows):
                page_id, url, payload, digest, place, holder, revisit = [c[k].as_py() for c in columns]
                raw = page_record(page_id, url, payload, digest, date, place - 1, (holder,) if revisit else None)
                held.append(compressor.compress(raw))
                size += len(held[-1])
                if size > STEP_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])

    frames = rows.mapInArrow(write, "value binary").select(F.col("value").cast("string").alias("value"))
    frames.write.options(lineSep=mark, maxRecordsPerFile=0).text(f"{folder}/files")
    spark.createDataFrame([(mark,)], "value string").coalesce(1).write.text(f"{folder}/mark")


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row for each page's record: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    `with_payload` adds the payload of responses. `payload_bytes` and `payload_digest` are of the whole
    payload, also for revisits, as their record states; those of responses are tested, and a damaged
    frame or payload raises. Files are read in splits, record by record.
    """
    mark = spark.read.text(f"{folder}/mark").first()["value"]
    frames = spark.read.option("lineSep", mark).text(f"{folder}/files").select(F.col("value").cast("binary").alias("frame"))
    magic = struct.pack("<I", DICTIONARY_MAGIC)
    leading = frames.where(F.substring("frame", 1, 4) == F.lit(magic)).limit(1).collect()
    dictionary = Dictionary(bytes(leading[0]["frame"])[8:] if leading else b"")
    names = [part.split()[0] for part in _READ.split(", ")] + (["payload"] if with_payload else [])
    schema = _READ + (", payload binary" if with_payload else "")
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = dictionary.decompressor()
        for batch in batches:
            held: list[dict] = []
            size = 0
            for frame in batch.column("frame"):
                raw = frame.as_buffer()
                if bytes(raw[:4]) == magic:
                    continue
                found = parse(decompressor.decompress(raw))
                if found is None:
                    continue
                held.append(found)
                size += found["payload_bytes"] if with_payload else 0
                if size > STEP_BYTES:
                    yield pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in held], types.get(c, pa.string())) for c in names})
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in held], types.get(c, pa.string())) for c in names})

    return frames.mapInArrow(read, schema)
