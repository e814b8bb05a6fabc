"""SimHash fingerprints of documents, and the components of near fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from isotherm.llm.batches import map_pieces, offsets_of
from isotherm.llm.hamming import connected, hamming_links
from isotherm.sources.scratch import staged

SEED = 42


def fingerprints_of(texts: list[bytes], width: int = 4) -> np.ndarray:
    """A bit is set if more than half of the text's shingle hashes have it. No words: zero."""
    hashes: list[int] = []
    counts = []
    for text in texts:
        words = text.lower().split()  # of bytes: ASCII letters, the six ASCII spaces
        n = len(words)
        if not n:
            counts.append(0)
            continue
        joined = b" ".join(words)
        if n <= width:
            hashes.append(xxh64_intdigest(joined, SEED))
            counts.append(1)
            continue
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, n)) + np.arange(n)).tolist()
        starts = [0, *[e + 1 for e in ends[: n - width]]]
        hashes.extend([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])])
        counts.append(n - width + 1)
    votes = np.array(counts, np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(votes)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals = np.add.reduceat(bits, offsets_of(votes[some])[:-1], axis=0, dtype=np.int64)
        set_bits = 2 * totals > votes[some][:, None]
        out[some] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(documents: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and `value`, the fingerprint as a signed 64-bit integer; null text has no words."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
        values = fingerprints_of(texts, width).view(np.int64)
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "value": pa.array(values)})

    return map_pieces(documents.select("doc_id", "text"), "text", step, "doc_id bigint, value bigint")


def near_components(documents: DataFrame, width: int = 4, budget: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for each row of `documents`.

    Documents link if their fingerprints differ in at most `budget` of 64 bits; component_id is the
    smallest doc_id reachable. Equal fingerprints are reduced to one value before the join and
    come back by it at the end, so copies are never paired with each other. Null or empty texts
    have fingerprint zero and link like others. Null ids take part but are never a component's id,
    unless it has no other: then that is null. Repeated rows give repeated rows. Other columns are
    not read.
    """
    docs = staged(fingerprints(documents, width), "fingerprints")
    values = staged(docs.groupBy("value").agg(F.min("doc_id").alias("first")), "values")
    links = hamming_links(values.select("value"), budget, values.count())
    roots = connected(links)
    grouped = staged(
        values.join(roots, values["value"] == roots["node"], "left").select(
            "value", "first", F.coalesce("root", "value").alias("root")
        ),
        "roots",
    )
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    by_value = grouped.join(smallest, "root").select("value", "component_id")
    return docs.join(by_value, "value").select(
        "doc_id", F.lpad(F.lower(F.hex("value")), 16, "0").alias("fingerprint"), "component_id"
    )
