"""From raw documents to token ids, in stages that are each stored before the next one reads them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from isotherm.llm import language, mixing, near_copies, piece_codec, quality
from isotherm.llm.batches import table
from isotherm.sources.scratch import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break a rule leave their text; documents that lose too much go."""
    return quality.clean_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a clear language go; the others carry the one found."""
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Copies are those that SimHash links at 4 bits of four-word shingles, and those with 0.8 or more
    of their five-word shingles in common.
    """
    return near_copies.one_of_each(docs, width=4, budget=4, similarity=0.8)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken not at all or up to three times, to meet the sources' targets."""
    return mixing.mixed_documents(docs, weights=(5, 2, 1), most=3)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and checksums of the ids and of the text they decode to."""
    return piece_codec.encode_decode(
        docs,
        public_tokenizers.path("piece_bpe_32k.model"),
        keep=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("piece_ids", piece_ids),
]

#: SQL has no forward-backward, trie or tokenizer; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
