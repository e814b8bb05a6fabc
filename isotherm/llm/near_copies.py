"""Near copies of documents: SimHash links, and pairs with enough five-word shingles in common.

SimHash at a few bits links copies with small changes all over, but misses most pairs whose shingle
sets are merely 0.8 alike. Those come from a second source: the smallest hashed shingles under many
hash functions, taken in bands, bring such pairs into a common bucket; candidates are then compared
exactly.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from isotherm.llm.batches import map_pieces, offsets_of, spare_names
from isotherm.llm.hamming import connected, hamming_links
from isotherm.llm.simhash import fingerprints_of
from isotherm.sources.scratch import cleared, staged

#: Words of a shingle, and the share of common shingles from which two texts are near copies.
WORDS = 5
SIMILARITY = 0.8

#: Bands, and smallest hashes in each: a pair at 0.8 shares a band with probability 0.998, one at 0.3 with 0.09.
BANDS, BAND_HASHES = 12, 4

#: Shingle sets that a comparing task remembers.
SETS_KEPT = 64

SEED = 77


def shingles_of(text: bytes, words: int = WORDS) -> np.ndarray:
    """Hashes of all shingles of a text in lower case; a shorter text is one shingle, one without words has none."""
    parts = text.lower().split()  # of bytes: ASCII letters, the six ASCII spaces
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if n <= words:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = (np.cumsum(np.fromiter(map(len, parts), np.int64, n)) + np.arange(n)).tolist()
    starts = [0, *[e + 1 for e in ends[: n - words]]]
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])], np.uint64)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    draws = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * BAND_HASHES), np.int64).astype(np.uint64)
    return draws[0] * np.uint64(2) + np.uint64(1), draws[1]


def bands_of(sets: list[np.ndarray]) -> np.ndarray:
    """A row for each set of shingle hashes: one 64-bit key for each band of its smallest hashes; sets are not empty."""
    flat, starts = np.concatenate(sets), offsets_of(np.array([len(s) for s in sets], np.int64))[:-1]
    smallest = np.empty((len(sets), BANDS * BAND_HASHES), np.uint64)
    for k, (a, b) in enumerate(zip(*_functions())):
        mixed = flat * a + b
        smallest[:, k] = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
    rows = smallest.reshape(len(sets) * BANDS, BAND_HASHES)
    keys = np.array([xxh64_intdigest(row.tobytes()) for row in rows], np.uint64)
    return keys.view(np.int64).reshape(len(sets), BANDS)


def _sketched(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
    sets = [shingles_of(t) for t in texts]
    some = [i for i, s in enumerate(sets) if len(s)]
    bands = np.zeros((len(texts), BANDS), np.int64)
    if some:
        bands[some] = bands_of([sets[i] for i in some])
    lengths = np.zeros(len(texts), np.int64)
    lengths[some] = BANDS
    return pa.RecordBatch.from_pydict(
        {
            "row": batch.column("row"),
            "doc_id": batch.column("doc_id"),
            "value": pa.array(fingerprints_of(texts, width).view(np.int64)),
            "same": pa.array([xxh3_128_digest(b" ".join(t.lower().split())) for t in texts], pa.binary()),
            "bands": pa.ListArray.from_arrays(
                pa.array(offsets_of(lengths).astype(np.int32)), pa.array(bands[some].ravel())
            ),
        }
    )


def least_by(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """`rows` with `first`, the smallest `value` of their `keys`, and `near`, the smallest under a salt as well.

    Rows meet under keys and salt, so one key with a third of all rows spreads over as many tasks as
    there are partitions.
    """
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(value), F.lit(salts)).cast("int"))
    partial = salted.groupBy(*keys, "salt").agg(F.min(value).alias("near"))
    first = partial.groupBy(*keys).agg(F.min("near").alias("first"))
    return salted.join(partial.join(first, keys), [*keys, "salt"]).drop("salt")


def _compared(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose texts (row, text) have `similarity` or more of their shingles in common.

    Texts of u move once for each pair, those of v once for each pair and salt, so a v of many pairs
    is no hot key.
    """
    salts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(salts)).cast("int"))
    left = pairs.join(texts.select(F.col("row").alias("u"), F.col("text").alias("u_text")), "u")
    right = pairs.select("v", "salt").distinct()
    right = right.join(texts.select(F.col("row").alias("v"), F.col("text").alias("v_text")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def shingles(row: int, text: str) -> np.ndarray:
            if row not in known:
                known[row] = np.unique(shingles_of(text.encode()))
                if len(known) > SETS_KEPT:
                    known.popitem(last=False)
            known.move_to_end(row)
            return known[row]

        for batch in batches:
            kept = []
            for k in range(batch.num_rows):
                u, v, u_text, v_text = (batch.column(c)[k].as_py() for c in ("u", "v", "u_text", "v_text"))
                a, b = np.unique(shingles_of(u_text.encode())), shingles(v, v_text)
                common = len(np.intersect1d(a, b, assume_unique=True))
                kept.append(common >= similarity * (len(a) + len(b) - common))
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    return left.join(right, ["v", "salt"]).select("u", "v", "u_text", "v_text").mapInArrow(run, "u bigint, v bigint")


def _candidates(distinct: DataFrame) -> DataFrame:
    """Pairs (u, v) and the number of bands that propose them: rows of a bucket with its first one.

    Rows meet under their bucket and a salt, then the first ones of each salt under the bucket, so a
    bucket of a third of all rows spreads over as many tasks as there are partitions. A key holds its
    band, so a row is two numbers.
    """
    salts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = F.transform("bands", lambda key, band: F.xxhash64(band, key))
    dealt = distinct.select("row", F.explode(keys).alias("key"))
    salt = F.pmod(F.xxhash64("row"), F.lit(salts))
    near = dealt.withColumn("near", F.first("row").over(Window.partitionBy("key", salt).orderBy("row")))
    firsts = near.where("row = near").select("key", "near")
    firsts = firsts.withColumn("first", F.first("near").over(Window.partitionBy("key").orderBy("near")))
    inner = near.where("row <> near").select(F.col("row").alias("u"), F.col("near").alias("v"))
    outer = firsts.where("near <> first").select(F.col("near").alias("u"), F.col("first").alias("v"))
    return inner.unionByName(outer).groupBy("u", "v").count()


def shingle_links(distinct: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (u, v) between the rows of `distinct` (row, bands) whose texts are near copies.

    Rows in a bucket of a band are candidates with the bucket's first row, or the first of their
    salt, instead of with each other. Each row is first compared with the partner that it has in most
    bands; what this connects need not be compared again, and all other candidates are. Only the
    texts of candidates move.
    """
    counted = staged(_candidates(distinct), "candidates")
    wanted = counted.select(F.explode(F.array("u", "v")).alias("row")).distinct()
    texts = staged(texts.join(wanted, "row"), "candidate_texts")
    best = counted.groupBy("u").agg(F.max(F.struct("count", (-F.col("v")).alias("v"))).alias("best"))
    near = staged(_compared(best.select("u", (-F.col("best.v")).alias("v")), texts, similarity), "near")
    roots = staged(connected(near), "near_roots")
    root = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    open_pairs = (
        counted.join(best.select("u", (-F.col("best.v")).alias("tried")), "u")
        .where("v <> tried")
        .join(root("u"), "u", "left")
        .join(root("v"), "v", "left")
        .where("coalesce(u_root, u) <> coalesce(v_root, v)")
        .select("u", "v")
    )
    rest = staged(_compared(open_pairs, texts, similarity), "far")
    return near.unionByName(rest)


def near_copy_groups(
    documents: DataFrame, width: int = 4, budget: int = 4, similarity: float = SIMILARITY
) -> DataFrame:
    """row, doc_id and root of each row of `documents` (row, unique; doc_id, text): equal roots are one group.

    Rows link if their words are the same, if their fingerprints of `width` words differ in at most
    `budget` bits, or if `similarity` or more of their five-word shingles are common. Null or empty
    texts are the same text.
    """
    fields = "row bigint, doc_id bigint, value bigint, same binary, bands array<bigint>"
    sketched = staged(
        map_pieces(documents.select("row", "doc_id", "text"), "text", lambda b: _sketched(b, width), fields), "sketches"
    )
    rows = staged(least_by(sketched.select("row", "doc_id", "same"), ["same"], "row").drop("near", "same"), "copies")
    shown = rows.where("row = first").select("row")
    distinct = staged(sketched.join(shown, "row", "left_semi").select("row", "value", "bands"), "distinct")
    values = staged(distinct.groupBy("value").agg(F.min("row").alias("node")), "values")
    bits = hamming_links(values.select("value"), budget, values.count())
    ends = [values.select(F.col("value").alias(c), F.col("node").alias(f"{c}_node")) for c in ("u", "v")]
    bits = bits.join(ends[0], "u").join(ends[1], "v").select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))
    same_bits = least_by(distinct.select("row", "value"), ["value"], "row").select(F.col("row").alias("u"), F.col("first").alias("v"))
    words = shingle_links(distinct.select("row", "bands"), documents.select("row", "text"), similarity)
    roots = connected(bits.unionByName(same_bits).unionByName(words))
    # every row of a node meets the node's root under a salt of its own
    salts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt")
    salted = rows.select("row", "doc_id", "first", salt)
    wanted = salted.select("first", "salt").distinct().join(roots, F.col("first") == F.col("node"), "left")
    wanted = wanted.select("first", "salt", F.coalesce("root", "first").alias("root"))
    return salted.join(wanted, ["first", "salt"]).select("row", "doc_id", "root")


def one_of_each(
    documents: DataFrame, width: int = 4, budget: int = 4, similarity: float = SIMILARITY
) -> DataFrame:
    """The row of each group of near copies with the smallest doc_id, the first one of equal ids, with all columns.

    Rows are numbered and stored first, so a repeated id with different texts is judged row by row.
    Rows without an id cannot be told apart and stay; they are no group's row. Documents without words
    are one group. Column names of any kind pass through. An empty table gives an empty result.
    """
    (number,) = spare_names(documents.columns, "row_number")
    numbered = staged(documents.withColumn(number, F.monotonically_increasing_id()), "numbered")
    with cleared(documents.sparkSession):
        found = near_copy_groups(numbered.select(F.col(number).alias("row"), "doc_id", "text"), width, budget, similarity)
        found = staged(found.where("doc_id IS NOT NULL"), "found")
        stays = found.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("first"))
        goes = staged(found.select("row").join(stays.select("first.row"), "row", "left_anti"), "goes", lasting=True)
    return numbered.join(goes.withColumnRenamed("row", number), number, "left_anti").select(
        *[F.col(f"`{c}`") for c in documents.columns]
    )
