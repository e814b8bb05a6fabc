"""WARC archives: which record is a revisit, the format of the files, and what comes back."""

from __future__ import annotations

import hashlib
import io
from collections import Counter
from pathlib import Path

import pytest
import zstandard

from isotherm.llm import queries, warc
from isotherm.sources.scratch import new_folder

SCHEMA = "page_id bigint, url string, html string, payload string, digest int, salt int, frame string"


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def expected(rows) -> Counter:
    """Brute force over the rows: the first of the largest ids of equal long payloads is the response."""
    groups: dict[bytes, list[int]] = {}
    for place, (page_id, _, html) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append(place)
    out = []
    for payload, places in groups.items():
        holder = max(places, key=lambda p: (rows[p][0] is not None, rows[p][0] or 0, -p))
        for place in places:
            again = len(payload) >= 1000 and place != holder
            out.append(
                (
                    rows[place][0],
                    len(payload),
                    hashlib.sha1(payload).hexdigest(),
                    "revisit" if again else "response",
                    rows[holder][0] if again else None,
                )
            )
    return Counter(out)


def archived(spark, rows, with_payload=False):
    folder = new_folder(spark, "archive")
    warc.write_archive(pages_frame(spark, rows), folder)
    return folder, warc.read_archive(spark, folder, with_payload)


def found(frame) -> Counter:
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return Counter(tuple(r[c] for c in columns) for r in frame.collect())


def hard_rows():
    long, other = "<p>" + "same words " * 120 + "</p>", "<p>" + "é日" * 400 + "</p>"
    return [
        (1, "http://a.example/1", long),
        (9, "http://a.example/9", long),
        (5, "http://a.example/5", long),
        (9, "http://a.example/9", long),  # a repeated row with the largest id
        (None, None, long),
        (2, "http://b.example/\r\nX: y é", "short"),
        (3, "", "short"),
        (4, "http://c.example/", None),
        (6, "http://c.example/", ""),
        (None, "http://n.example/", other),
        (None, "http://n.example/", other),
        (7, "http://d.example/", "P*M\x18 \x00\x00\x00" * 200),
        (8, "http://e.example/", "x" * 2_000_000),
        (10, "http://f.example/", "y" * 999),
        (11, "http://f.example/", "y" * 999),
        (12, "http://f.example/", "é" * 500),
        (13, "http://f.example/", "é" * 500),
        (14, "http://g.example/", "\r\n\r\nWARC/1.1\r\n\r\n"),
    ]


def test_hard_rows(spark):
    rows = hard_rows()
    folder, frame = archived(spark, rows, with_payload=True)
    assert found(frame) == expected(rows)
    given = Counter((html or "").encode() for _, _, html in rows)
    for r in frame.collect():
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] and bytes(r["payload"]) in given
        else:
            assert r["payload"] is None
    urls = {r["page_id"]: r["url"] for r in frame.where("page_id is not null").collect()}
    assert urls[9] == "http://a.example/9" and urls[2] == "http://b.example/%0D%0AX:%20y%20%C3%A9"


def test_files_are_a_stream_of_warc_records(spark):
    rows = hard_rows()
    folder, _ = archived(spark, rows)
    seen = 0
    for file in Path(f"{folder}/files").glob("part-*"):
        raw = file.read_bytes()
        magic, size = warc.struct.unpack("<II", raw[:8])
        assert magic == warc.DICTIONARY_MAGIC  # the first frame carries the dictionary
        decompressor = warc.Dictionary(raw[8 : 8 + size]).decompressor()
        stream = decompressor.stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        records = stream.split(b"WARC/1.1\r\nWARC-Type: ")[1:]
        assert records[0].startswith(b"warcinfo")
        seen += sum(r.startswith((b"response", b"revisit")) for r in records)
    assert seen == len(rows)


def test_one_large_group_of_copies(spark):
    rows = [(i, f"http://h.example/{i}", "copy " * 300) for i in range(3000)]
    rows += [(10_000 + i, f"http://h.example/o{i}", f"own {i} " * 200) for i in range(500)]
    _, frame = archived(spark, rows)
    assert found(frame) == expected(rows)


def test_empty_table_and_damage(spark):
    _, frame = archived(spark, [])
    assert frame.count() == 0 and frame.columns[0] == "page_id"
    rows = [(i, f"http://a.example/{i}", f"text {i} " * 200) for i in range(50)]
    folder, frame = archived(spark, rows)
    raw = warc.page_record(1, "u", b"payload", hashlib.sha1(b"other").hexdigest(), "2000-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw)
    with pytest.raises(ValueError, match="length"):
        warc.parse(raw[:-3])
    compressed = warc.Dictionary(b"").compressor().compress(raw * 3)
    broken = compressed[:20] + bytes([compressed[20] ^ 255]) + compressed[21:]
    with pytest.raises(zstandard.ZstdError):
        warc.Dictionary(b"").decompressor().decompress(broken)


def test_the_dictionary_makes_small_records_smaller():
    records = [
        warc.page_record(i, f"http://h.example/{i}", f"<nav>menu of the site</nav><p>page {i}</p>".encode() * 3, "0" * 40, "2000-01-01T00:00:00Z")
        for i in range(400)
    ]
    dictionary, without = warc.Dictionary.fitted(records), warc.Dictionary(b"")
    assert len(dictionary.content) <= warc.DICTIONARY_BYTES
    with_it, alone = (sum(len(d.compressor().compress(r)) for r in records) for d in (dictionary, without))
    assert with_it * 2 < alone
    assert all(dictionary.decompressor().decompress(dictionary.compressor().compress(r)) == r for r in records[:20])


def test_registered_query(spark, sf_middle):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf_middle}/pages.parquet").collect()]
    assert found(queries.QUERIES["op13_warc_dictionary"](spark, sf_middle)) == expected(rows)
