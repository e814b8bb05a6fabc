"""Token files: exact round trips, starts, checkpoints and damage."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_cases import empty_frame, hard_frame, hard_rows, noise
from tokenizers import Tokenizer

from isotherm.llm import token_store
from isotherm.sources.scratch import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("lanes", [1, 7, 64])
def test_coding_is_a_round_trip_from_every_checkpoint(lanes):
    rng = np.random.default_rng(lanes)
    ids = np.minimum(rng.geometric(0.02, 40_000) * 3, 50_000).astype(np.uint32)
    table = token_store.Table.of(ids)
    assert table.frequencies.sum() == 1 << token_store.SCALE_BITS and table.frequencies.min() >= 1
    words, saved, steps = table.encode(ids, lanes)
    wide = words.astype(np.uint64)
    whole = table.decode(wide, saved, lanes, 0, steps)
    assert (whole.ravel()[: len(ids)] == ids).all()
    first = token_store.CHECKPOINT_STEPS
    part = table.decode(wide, saved, lanes, first, min(steps, first + 5))
    assert (part == whole[first : first + 5]).all()


def test_a_single_symbol_and_rare_symbols():
    for ids in (np.zeros(100, np.uint32), np.r_[np.zeros(10**6, np.uint32), np.arange(3000, dtype=np.uint32)]):
        table = token_store.Table.of(ids)
        words, saved, steps = table.encode(ids, 8)
        assert (table.decode(words.astype(np.uint64), saved, 8, 0, steps).ravel()[: len(ids)] == ids).all()


def test_ids_equal_the_library():
    tokens = token_store.load(PATH)
    texts = [*noise(11, 4000), "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", " ab.<|endoftext|>", ""]
    ids, counts = tokens.encode(texts, 2)
    ends = np.cumsum(counts)
    for i, text in enumerate(texts):
        expected = tokens.tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert ids[ends[i] - counts[i] : ends[i]].tolist() == expected, text


def test_files_hold_all_documents_in_order(spark, sf_small):
    documents = spark.read.parquet(f"{sf_small}/documents.parquet")
    folder = new_folder(spark, "tokens")
    token_store.write_tokens(documents, PATH, folder, end_id=2)
    library = Tokenizer.from_file(PATH)
    rows = sorted(documents.select("doc_id", "text").collect())
    expected, start = {}, 0
    for r in rows:
        ids = library.encode(r["text"], add_special_tokens=False).ids + [2]
        expected[r["doc_id"]] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    found = token_store.read_tokens(spark, folder).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) for r in found} == expected


def test_hard_rows_and_empty_tables(spark):
    folder = new_folder(spark, "tokens")
    token_store.write_tokens(hard_frame(spark), PATH, folder, end_id=2)
    found = token_store.read_tokens(spark, folder, with_ids=False).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in hard_rows())
    ends = sorted((r["start"], r["n_tokens"]) for r in found)
    assert ends[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))
    assert all(r["n_tokens"] == 1 for r in found if r["doc_id"] in (1, 2))
    for frame, end in ((empty_frame(spark), 2), (hard_frame(spark).where("doc_id < 3"), None)):
        folder = new_folder(spark, "tokens")
        token_store.write_tokens(frame, PATH, folder, end_id=end)
        read = token_store.read_tokens(spark, folder).collect()
        assert len(read) == frame.count() and all(r["n_tokens"] == 0 for r in read)


def test_rows_without_id_spread_over_parts(spark):
    frame = spark.range(100_000).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id % 5000) as text")
    folder = new_folder(spark, "tokens")
    token_store.write_tokens(frame, PATH, folder, end_id=2)
    parts = spark.read.schema(token_store.SCHEMA).parquet(folder).select("part", "doc_ids").collect()
    assert len({r["part"] for r in parts}) == 8 and max(len(r["doc_ids"]) for r in parts) < 30_000
    read = token_store.read_tokens(spark, folder, with_ids=False)
    ends = sorted((r["start"], r["n_tokens"]) for r in read.collect())
    assert len(ends) == 100_000 and ends[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))


def test_checksums_join():
    rng = np.random.default_rng(3)
    for _ in range(30):
        parts = [rng.bytes(int(rng.integers(0, 300))) for _ in range(int(rng.integers(1, 6)))]
        assert token_store.joined_crc32([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_a_long_document_is_decoded_in_ranges(spark):
    rng = np.random.default_rng(8)
    words = np.array(["river", "stone", "über", "x", "12", "walk", "the"])
    texts = ["first", " ".join(words[rng.integers(0, 7, 2_600_000)]), "", "last one"]
    folder = new_folder(spark, "tokens")
    token_store.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1), PATH, folder, end_id=2)
    stored = spark.read.schema(token_store.SCHEMA).parquet(folder)
    longest = stored.where(stored["longest"] > token_store.WHOLE_STEPS)
    assert longest.count() == 1 and longest.mapInArrow(token_store._ranges, token_store._RANGE).count() > 1
    library, start = Tokenizer.from_file(PATH), 0
    found = {r["doc_id"]: r for r in token_store.read_tokens(spark, folder).collect()}
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        r = found[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert (np.array(r["ids"], "<u4") == ids).all()
        start += len(ids)


def test_damage_is_found(spark, sf_small):
    folder = new_folder(spark, "tokens")
    token_store.write_tokens(spark.read.parquet(f"{sf_small}/documents.parquet").limit(20), PATH, folder)
    row = spark.read.schema(token_store.SCHEMA).parquet(folder).first().asDict(recursive=True)
    assert len(token_store.decoded(row)) == sum(row["n_tokens"])
    words = bytearray(row["blocks"][0]["words"])
    words[len(words) // 2] ^= 1
    row["blocks"][0]["words"] = bytes(words)
    with pytest.raises(ValueError, match="damaged"):
        token_store.decoded(row)
